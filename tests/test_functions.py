import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_of
from learnlake.functions import ids, text
from learnlake.functions.keys import _normal_text, in_place, normal_events, normalize, normalize_json
from learnlake.functions.paths import at, at_or, column_name, json_path, not_null, present
from learnlake.schemas.events import wide_paths


def test_json_path():
    assert json_path("a.`http://x.y`.c[0].d") == '$["a"]["http://x.y"]["c"][0]["d"]'
    assert json_path("") == "$"
    assert column_name("a.`http://x`.b[0]") == "a_http_x_b_0"


def test_wide_paths_are_distinct():
    names = [column_name(p) for p in wide_paths()]
    assert len(names) == 106 == len(set(names))


def test_lax_navigation(docs):
    df = docs({"a": None}, {"a": {"b": [1, "x"]}}, {"a": {"b": []}}, {"a": "text"}, "broken")
    got = df.select(
        "n", at("doc", "a.b[1]"), at_or("doc", "a.b[0]", "none"), present("doc", "a"), not_null("doc", "a")
    ).collect()
    assert [tuple(r)[1:] for r in got] == [
        (None, "none", True, False), ("x", "1", True, True), (None, "none", True, True), (None, "none", True, True),
        (None, "none", False, None) if got[4][4] is None else (None, "none", False, False),
    ]


def test_repeated_json_key_keeps_the_last(docs):
    assert docs('{"a": 1, "a": 2}').select(at("doc", "a")).first()[0] == "2"


def _cut(value, limit):
    while len(value.encode()) > limit:
        value = value[:-1]
    return value


def test_truncate_bytes(spark):
    rng = random.Random(7)
    values = ["".join(rng.choice("aé漢😀") for _ in range(rng.randrange(0, 400))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", text.truncate_bytes(F.col("v"), 256))
    for value, got in df.collect():
        assert got == (None if value is None else _cut(value, 256))


def test_chunks(spark):
    values = ["", "a", "ab" * 500, "é" * 1001, None, "x" * 1000]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", text.chunks(F.col("v"), 250))
    for value, got in df.collect():
        expected = [None] if value is None else [value[i:i + 250] for i in range(0, len(value), 250)] or [""]
        assert got == expected


def test_names_and_addresses(spark):
    df = spark.createDataFrame([("a", "", "c"), (None, None, None), ("", "b", "")], "x string, y string, z string")
    got = df.select(text.full_name(*map(F.col, "xyz")), text.full_address(*map(F.col, "xyz")))
    assert [tuple(r) for r in got.collect()] == [("a c", "a, , c"), ("", ""), ("b", "b")]


def test_ids(spark):
    df = spark.createDataFrame([("7",), ("-1",), ("None",), ("1234567890123456",), ("x",), (None,)], "v string")
    got = df.select(ids.padded_uuid(F.col("v")), ids.sentinel_to_null(F.col("v")), ids.score(F.col("v"))).collect()
    assert got[0] == ("00000000-0000-1000-0000-000000000007", "7", 7.0)
    assert got[1][1] is None and got[2][2] is None and got[4][2] is None
    assert got[3][0].endswith("123456789012")
    assert got[5] == (None, None, None)


def test_buckets_are_never_negative(spark):
    df = spark.range(5000).select(F.hash(F.col("id").cast("string")).alias("h"), ids.bucket(F.col("id").cast("string"), 50).alias("b"))
    assert df.where("h < 0").count() > 0
    assert df.where("b < 0 OR b >= 50").count() == 0


def test_sequence_numbers_sort_as_numbers(spark):
    numbers = [9, 10, 10**55, 3 * 10**55, 10**30]
    df = spark.createDataFrame([(str(n),) for n in numbers], "v string")
    assert [int(r.v) for r in df.orderBy(ids.sequence_key(F.col("v"))).collect()] == sorted(numbers)


KEYS = st.text(alphabet="aB_-c", min_size=0, max_size=4)
JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text(alphabet="x'\"\\ é", max_size=4),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(KEYS, inner, max_size=4),
    max_leaves=12,
)


def _keys(value):
    if isinstance(value, dict):
        return set(value) | {k for v in value.values() for k in _keys(v)}
    return {k for v in value for k in _keys(v)} if isinstance(value, list) else set()


@settings(max_examples=200, deadline=None)
@given(JSON)
def test_normalizing_twice_changes_nothing(value):
    once = _normal_text(json.dumps(value))
    assert _normal_text(once) == once
    assert all(k == k.lower() and "_" not in k and "-" not in k for k in _keys(json.loads(once)))


def test_normalize_json(spark):
    texts = ['{"A_b": {"C-d": [{"E_F": 1}]}, "relatedAgents": ["\'a\' \\\\\\"b\\"", {"X_": 1}], "unitId": 1, "unit_id": 2}', "bad", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(normalize_json("t")).collect()]
    assert json.loads(got[0]) == {"ab": {"cd": [{"ef": 1}]}, "relatedagents": ["a b", {"x": 1}], "unitid": 2}
    assert got[1:] == [None, None]


def test_native_and_text_normalization_agree(spark):
    schema = """A_b struct<`C-d`: array<struct<E_F:int>>>, relatedAgents array<string>, unitId string, unit_id string,
        M map<string,struct<Z_z:int>>"""
    rows = [
        ({"C-d": [{"E_F": 1}, {"E_F": 2}]}, ["'q' \\\"z\""], "1", "2", {"K_k": {"Z_z": 3}, "kk": {"Z_z": 4}}),
        (None, None, "1", None, None),
    ]
    df = spark.createDataFrame(rows, schema).select(F.struct("*").alias("e"))
    native = df.select(F.to_json(normalize(F.col("e"), df.schema["e"].dataType)).alias("j"))
    by_text = df.select(normalize_json(F.to_json("e")).alias("j"))
    assert [json.loads(r.j) for r in native.collect()] == [json.loads(r.j) for r in by_text.collect()]


def test_joined_list(docs):
    df = docs({"v": ["a", "b"]}, {"v": "one"}, {}, {"v": None}, {"v": []}).select(text.joined_list("doc", "v").alias("v"))
    assert [r.v for r in df.collect()] == ["a,b", "one", "", None, ""]
    assert rows_of(docs({"v": [1, 2]}).select(text.joined_list("doc", "v"))) == [("1,2",)]


def test_keys_renamed_in_place_agree_with_the_function(spark):
    rng = random.Random(13)
    words = ["A_b", "a-B", "", ",x", ": y", "}", "]", 'q"Z_', "b\\", "é_É", "relatedAgents", "related_agents", "it's", "c\\\\\"d", ":X_Y", ",-1E5,", "\n_N"]

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 4:
            return rng.choice([rng.choice(words), rng.randrange(9), None, -1.5])
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(words): value(depth - 1) for _ in range(rng.randrange(4))}

    texts = []
    for i in range(3000):
        made = {f"K_{j}": value(3) for j in range(3)} | {rng.choice(words[:2] + words[9:12]): value(2)}
        text = json.dumps(made if i % 5 else [made], indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        texts.append(text + rng.choice([""] * 9 + [" ", " x", "}", "]", ' {"a": 1}']))
    texts += [None, "", "5", '"s"', "null", "[]", "{}", "{", '{"a":1}{"a":1}', '{"related_agents": ["a]b", "\'c\'", "\\"d\\""], "E": ["x", ":Y_Z"]}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, payload string").withColumn("doc", F.try_parse_json("payload"))
    got = {r.i: r.j for r in normal_events(df).select("i", F.to_json("event").alias("j")).collect()}
    old = df.select("i", F.to_json(F.try_parse_json(normalize_json("payload"))).alias("j"))
    assert got == {r.i: r.j for r in old.collect()}


def test_usual_events_are_renamed_without_python(spark):
    """Of the learning events no text reaches the Python function."""
    from learnlake.queries import inputs
    from learnlake.queries.registry import Tables
    from learnlake.sources import envelope

    good = envelope.good(envelope.decode(inputs.learning_records(Tables(spark, "/root/testdata/sf0.001"))))
    named = in_place(good)
    assert named.count() > 0 and named.where("named IS NULL").count() == 0
    assert "Python" not in named._jdf.queryExecution().executedPlan().toString()
