import base64
import json

from pyspark.sql import functions as F

from conftest import rows_of
from learnlake.operators import routing
from learnlake.schemas.events import ENVELOPE, NESTED_ENVELOPE, VERB_PREFIX
from learnlake.sources import envelope


def b64(value):
    raw = value if isinstance(value, (bytes, str)) else json.dumps(value)
    return base64.b64encode(raw if isinstance(raw, bytes) else raw.encode()).decode()


def test_decode_keeps_good_and_explains_bad(spark):
    data = [b64({"a": "é"}), b64("plain text"), b64(b"\xff\xfe"), "abc", None, "%%" + b64({"b": 1}) + "%", b64("[1]")]
    rows = envelope.decode(spark.createDataFrame([(d,) for d in data], "data string"))
    assert [r.error for r in rows.collect()] == [
        None, "not JSON", "not base64 text", "not base64 text", "no data", None, None
    ]
    assert envelope.good(rows).count() == 3 and envelope.bad(rows).count() == 4
    assert "data" not in rows.columns


def test_parse_runs_once(spark):
    """Filters on the parsed document do not repeat the parse."""
    rows = envelope.good(envelope.decode(spark.createDataFrame([("e30=",)], "data string"))).where(
        routing.verb_raw_first("doc").isNotNull()
    )
    assert rows._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1


def test_flat_and_nested_agree(spark):
    record = {"eventSource": "aws:kinesis", "eventID": "shard-1:9", "data": b64({"id": 1}), "partitionKey": "p", "sequenceNumber": "9"}
    flat = spark.createDataFrame([(json.dumps(record),)], "t string").select(F.from_json("t", ENVELOPE).alias("r")).select("r.*")
    inner = {k: record[k] for k in ("data", "partitionKey", "sequenceNumber")}
    nested = {"Records": [{"eventSource": "aws:kinesis", "eventID": "shard-1:9", "kinesis": inner}]}
    batch = spark.createDataFrame([(json.dumps(nested),)], "t string").select(F.from_json("t", NESTED_ENVELOPE).alias("r")).select("r.*")
    columns = ["eventID", "partitionKey", "sequenceNumber", "payload"]
    assert rows_of(envelope.decode(flat), *columns) == rows_of(envelope.decode(envelope.unnest(batch)), *columns)
    log = envelope.ingest_log(flat, "s", F.lit("u")).first()
    assert (log.shard_id, log.sequence_number, log.kinesis_name) == ("shard-1", "9", "s")


def test_free_form(spark):
    good, other = {"eventSource": "aws:kinesis", "data": b64({"n": 1})}, {"eventSource": "x", "data": b64({"n": 2})}
    broken = {"eventSource": "aws:kinesis", "data": b64("nope")}
    texts = {
        "list": json.dumps([good, other, broken]),
        "single": json.dumps(good),
        "records": json.dumps({"Records": [{"kinesis": {"data": b64({"n": 3})}}, {"other": 1}]}),
        "foreign list falls back": json.dumps([other]),
        "text": '<<"data" : "%s">> "data":"%s"' % (b64({"n": 4}), b64("nope")),
        "nothing": "{}",
        "null": None,
    }
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    got = rows_of(envelope.free_form(df), "name", "payload")
    assert got == sorted([
        ("list", '{"n": 1}'), ("single", '{"n": 1}'), ("records", '{"n": 3}'), ("foreign list falls back", '{"n": 2}'),
        ("text", '{"n": 4}'),
    ], key=repr)


def test_queue(spark):
    bodies = [json.dumps({"data": b64({"n": 1})}), "{broken", json.dumps({"x": 1})]
    text = json.dumps({"Records": [{"messageId": f"m{i}" if i else None, "body": b} for i, b in enumerate(bodies)]})
    rows = envelope.from_queue(envelope.queue_messages(spark.createDataFrame([(text,)], "text string")))
    assert rows_of(rows, "messageId", "payload", "error") == [
        ("m1", None, "no data"), ("m2", None, "no data"), ("unknown", '{"n": 1}', None)
    ]


def test_verb_rules(docs):
    df = docs(
        {"verbID": "a", "statement": {"verb": {"id": "b"}}},
        {"statement": {"verb": {"id": "b"}}},
        {"verbID": None, "statement": {"verb": {"id": "b"}}, "verb": {"id": "c"}},
        {"statement": {}, "verb": {"id": "c"}},
        {"statement": "text", "verb": {"id": "c"}},
        {"verbid": "n"},
    ).orderBy("n")
    rules = [routing.verb_raw_first, routing.verb_normalized, routing.verb_object_first, routing.verb_id_only]
    got = [tuple(r) for r in df.select(*[rule("doc") for rule in rules]).collect()]
    assert got == [
        ("a", "b", "a", "a"), ("b", "b", None, None), (None, "b", "c", None), (None, None, "c", None), (None, "c", "c", None),
        (None, "n", None, None),
    ]


def test_tables_and_types(spark):
    verbs = [VERB_PREFIX + "completed", "http://x/odd", "odd", None]
    df = spark.createDataFrame([(v,) for v in verbs], "v string")
    got = df.select(
        routing.raw_table(F.col("v")), routing.raw_table(F.col("v"), None), routing.event_type(F.col("v")), routing.stream_route(F.col("v"))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("lrs_events_completed", "lrs_events_completed", "completed", None), ("lrs_events_all", None, "odd", None),
        ("lrs_events_all", None, "unknown", None), (None, None, "event", None),
    ]


def test_action_and_entity_guards(spark):
    df = spark.createDataFrame([("User_CREATED",), ("x_updated",), ("x_Deleted",), ("other",), ("created_updated",), (None,)], "a string")
    got = [tuple(r) for r in df.select(routing.is_created_job(F.col("a")), routing.is_change_job(F.col("a"))).collect()]
    assert got == [(True, False), (False, True), (False, True), (True, False), (False, False), (True, False)]
    entities = spark.createDataFrame([("USER",), ("ARTICLE",), ("",), (None,), ("NEW",)], "e string")
    assert [r[0] for r in entities.select(routing.has_projected_entity(F.col("e"))).collect()] == [True, False, False, False, True]
