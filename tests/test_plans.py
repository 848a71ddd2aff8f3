import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows_of
from learnlake.plans import admin, fact, history, lrs_batch, lrs_stream, reading
from learnlake.schemas import gold
from learnlake.schemas.events import ACT_TYPE, IDS, SCORM, VERB_PREFIX
from learnlake.sinks.tables import write_bucketed


def event(verb, kind=None, extensions=None, result=None, **more):
    definition = {"interactionType": kind, "extensions": extensions} if extensions is not None else {"interactionType": kind}
    statement = {"id": "s1", "timestamp": "t", "stored": "st", "verb": {"id": VERB_PREFIX + verb, "display": {"und": verb}},
                 "object": {"id": "o1", "definition": definition}}
    if result is not None:
        statement["result"] = result
    return {"id": "e1", "lrs_id": "l", "client_id": "c", "verbID": VERB_PREFIX + verb, "statement": statement} | more


ACT = {ACT_TYPE: {"resourceRefId": "rr", "resourceId": "r"}}
ID_BLOCK = {IDS: {"resourceRefId": "ir", "schoolRefId": "sc"}}


# -- learning stream ------------------------------------------------------------------------------------------------
def counts(events):
    return {t.split("lrs_")[1]: build(events).count() for t, build in lrs_stream.TARGETS.items()}


def test_which_tables_each_verb_feeds(docs):
    three = {"statement": 1, "verb": 1, "object_http": 1, "result": 0, "result_scorm": 0}
    none = dict.fromkeys(three, 0)
    assert counts(docs(event("answered", "choice", ACT))) == three
    assert counts(docs(event("answered", "matching", ACT))) == three | {"result_scorm": 1}
    assert counts(docs(event("answered"))) == three
    assert counts(docs(event("experienced", extensions=ID_BLOCK))) == three
    assert counts(docs(event("experienced", extensions={}))) == none
    assert counts(docs(event("attempted", extensions=ID_BLOCK))) == none
    assert counts(docs(event("terminated"))) == three
    assert counts(docs(event("terminated", result={"completion": True}))) == three | {"result": 1}
    assert counts(docs(event("completed", extensions=ACT))) == none


def test_unknown_verbs(docs):
    df = docs(event("completed"), event("attempted"), {"id": "x"}, event("initialized"))
    assert [r.n for r in lrs_stream.unknown(df).orderBy("n").collect()] == [0, 2, 3]


def test_object_block_depends_on_verb(docs):
    both = ACT | ID_BLOCK
    rows = lrs_stream.object_http(docs(event("answered", extensions=both), event("terminated", extensions=both)))
    assert rows_of(rows, "resource_ref_id", "resource_id", "school_id") == [("ir", None, "sc"), ("rr", "r", None)]
    assert rows.columns == gold.COLUMNS["gold.dim_lrs_object_http"]


def test_long_answers_span_rows(docs):
    answer = "é" * 150_000
    result = {"extensions": {SCORM: {"response": answer, "correctResponsesPattern": "p"}}}
    rows = lrs_stream.result_scorm(docs(event("answered", "long-fill-in", ACT, result))).orderBy("chunk_no").collect()
    assert [len(r.response) for r in rows] == [64_000, 64_000, 22_000]
    assert "".join(r.response for r in rows) == answer and {r.correct_responses_pattern for r in rows} == {"p"}
    whole = lrs_stream.result_scorm(docs(event("answered", "matching", ACT, result))).collect()
    assert [len(r.response) for r in whole] == [150_000]


def test_terminated_result(docs):
    result = {"completion": True, "success": False, "duration": "PT5M", "score": {"raw": 7.5, "scaled": None}}
    row = lrs_stream.result(docs(event("terminated", "other", result=result))).first()
    assert (row.success_status, row.completion, row.score_raw, row.score_scaled, row.interaction_type, row.extensions) == (
        "true", "true", "7.5", None, "other", SCORM
    )


def test_json_null_on_the_way_keeps_the_event(docs):
    row = lrs_stream.statement(docs({"id": "e", "verbID": VERB_PREFIX + "answered", "statement": None})).first()
    assert row.id_system == "e" and row.statement_id is None


# -- batch dimensions -----------------------------------------------------------------------------------------------
def test_batch_extension_filter(docs):
    block = {"http://acttype": {"unitid": "u", "rolid": 3}}
    shape = lambda ext: {"id": "e", "statement": {"object": {"definition": {"extensions": ext}}}}
    raw = docs(shape(block), shape({"http://acttype": None}), shape({})).select(
        F.col("doc").alias("event"), F.timestamp_seconds("n").alias("dt_load")
    )
    assert rows_of(lrs_batch.dimension(raw, "dim_lrs_object_http"), "unit_id", "role_id", "school_id") == [("u", "3", None)]
    assert lrs_batch.dimension(raw, "dim_lrs_actor").count() == 3
    low, high = F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(1))
    assert lrs_batch.dimension(raw, "dim_lrs_actor", low, high).count() == 1


# -- administration -------------------------------------------------------------------------------------------------
def admin_event(entity, **attributes):
    return {"meta": {"entityKey": entity, "action": "x_created"}, "data": {"attributes": attributes}}


def test_every_entity_has_tables():
    tables = {t for ts in admin.ENTITY_TABLES.values() for t in ts}
    assert tables == set(admin.TARGETS) == set(gold.KEYS)
    assert len(admin.ENTITY_TABLES) == 10


def test_first_of_list_or_nulls(docs):
    phone = lambda n: {"phoneNumber": {"number": n, "phoneNumberType": "t"}}
    df = docs(
        admin_event("USER", refId="a", phoneNumberList=[phone("1"), phone("2")]),
        admin_event("USER", refId="b", phoneNumberList=[]), admin_event("USER", refId="c"),
        admin_event("UNOSCHOOL", refId="d", phoneNumberList=[phone("3")]),
    )
    assert rows_of(admin.TARGETS["gold.dim_user_phone"](df), "user_phone_id", "phone_number") == [
        ("a", "1"), ("b", None), ("c", None)
    ]
    assert rows_of(admin.TARGETS["gold.dim_school_phone"](df)) == [("d", "3", "t")]


def test_user_email_lists(docs):
    person, user = [{"personEmail": {"email": "p"}}], [{"userEmail": {"email": "u"}}]
    df = docs(
        admin_event("USER", refId="1", personEmailList=person, userEmailList=user),
        admin_event("USER", refId="2", personEmailList=[], userEmailList=user),
        admin_event("USER", refId="3", personEmailList=user),
        admin_event("USER", refId="4"),
    )
    assert rows_of(admin.TARGETS["gold.dim_user_email"](df), "user_email_id", "email") == [
        ("1", "p"), ("2", "u"), ("3", "u"), ("4", None)
    ]


def test_names_and_addresses(docs):
    address = {"address": {"street": {"line1": "s"}, "city": "c", "postalCode": "9"}}
    df = docs(
        admin_event("USER", refId="1", name={"firstName": "A", "lastName": "B"}, addressList=[address], country={"refId": "x"}),
        admin_event("USER", refId="2", country={"refId": "y"}),
        admin_event("UNOSCHOOL", refId="3", addressList=[address]),
    )
    user = admin.TARGETS["gold.dim_user"](df)
    assert rows_of(user, "user_id", "full_name", "first_name", "second_name") == [("1", "A B", "A", ""), ("2", "", "", "")]
    assert rows_of(admin.TARGETS["gold.dim_user_address"](df), "full_address", "neighborhood", "postal_code", "country_id") == [
        ("s, , c", "", "9", "x"), (None, None, None, "y")
    ]
    assert rows_of(admin.TARGETS["gold.dim_school_address"](df), "full_address", "postal_code") == [("s, , c, 9", "9")]


def test_user_lists(docs):
    users = [{"personRefId": "p1", "active": True}, {"personRefId": "p2"}]
    df = docs(
        admin_event("USERSCHOOLCLASS", schoolClass={"refId": "k"}, userList=users),
        admin_event("USERSCHOOLCLASS", schoolClass={"refId": "m"}, userList=[]),
        admin_event("USERGROUP", group={"refId": "g"}, userList=users),
    )
    assert rows_of(admin.TARGETS["gold.dim_class_participant"](df), "section_id", "user_id", "active_status") == [
        ("k", "p1", "true"), ("k", "p2", None), ("m", None, None)
    ]
    assert rows_of(admin.TARGETS["gold.dim_user_group"](df, ["n"]), "group_id", "person_id", "item_no") == [
        ("g", "p1", 0), ("g", "p2", 1)
    ]


# -- reading plan ---------------------------------------------------------------------------------------------------
def test_reading_rows(docs):
    df = docs(
        {"type": "acceso", "action": "A", "data": [{"id": 1, "ip": "i"}, {"id": 2, "user_id": "u", "book_pack_ids": [1, 2]}]},
        {"type": "callback", "data": []}, {"type": "other", "data": [{"id": 3}]}, {"data": [{"id": 4}]},
    )
    assert rows_of(reading.from_stream(df), "id", "user_id", "ip_address", "title", "book_pack_ids", "info_origin", "type_event") == [
        ("1", "u", "i", "", None, None, "acceso"), ("2", "u", "", "", "[1,2]", None, "acceso")
    ]
    queue = reading.from_queue(df)
    assert rows_of(queue, "id", "user_id", "title", "info_origin") == [
        ("1", "u", None, reading.NO_INFO), ("2", "u", None, reading.NO_INFO), ("3", None, None, reading.NO_INFO),
        ("4", None, None, reading.NO_INFO),
    ]
    assert queue.columns == gold.COLUMNS["stream.lql"] and len(queue.columns) == 51


def test_info_block(docs):
    df = docs({"data": [{"id": 1}], "info": {"user_id": "u", "http_flow": {"origin": "o"}}}, {"data": [{"id": 2}], "info": None})
    assert rows_of(reading.from_queue(df), "info_user_id", "info_origin", "info_target") == [
        (reading.NO_INFO,) * 3, ("u", "o", reading.NO_INFO)
    ]


# -- fact -----------------------------------------------------------------------------------------------------------
KEY = "lrs_id string, client_id string, statement_id string"


def fact_inputs(spark):
    frame = spark.createDataFrame
    http = [c for c in fact.BASE if c not in fact.KEY]
    row = lambda sid, **v: ("l", "c", sid, *[v.get(c) for c in http])
    answered = fact.ANSWERED
    return {
        "dim_lrs_verb": frame([("l", "c", s, answered) for s in ("1", "1", "2", "3")] + [("l", "c", "4", "other")], KEY + ", verb_id string"),
        "dim_lrs_object_http": frame([
            row("1", student_id="5", school_id="100", learning_unit_id="u1", learning_objective_id="-1", learning_level_id="7"),
            row("1", student_id="5", school_id="100", learning_unit_id="u1", learning_objective_id="-1", learning_level_id="7"),
            row("2", student_id="1234567890123", school_id="200"), row("3", school_id="300", learning_unit_id="none"), row("4"),
        ], KEY + "".join(f", {c} string" for c in http)),
        "dim_lrs_result": frame([
            ("l", "c", "1", None, "None", "other", SCORM, "resp"), ("l", "c", "1", True, "2.5", "choice", "x", "resp"),
            ("l", "c", "2", False, "bad", None, None, "r2"),
        ], KEY + ", success_status boolean, score_raw string, interaction_type string, extensions string, response string"),
        "dim_lrs_result_scorm": frame([("l", "c", "1", "p", "sr", "img"), ("l", "c", "2", "p", "sr", "img")],
                                      KEY + ", correct_responses_pattern string, response string, image string"),
        "dim_lrs_statement": frame([("l", "c", "1", "t1")], KEY + ", dt_time string"),
        "dim_page": frame([("g1", "u1"), ("g2", "u1"), ("g3", None)], "page_id string, learning_unit_id string"),
        "dim_resource": frame([("r1", "g1"), ("r2", "g2")], "resource_id string, page_id string"),
        "dim_activity": frame([("r1", "a", 3), ("r2", "b", 1), ("r9", "z", 9)], "resource_id string, activity_type string, activity_attempts int"),
        "dim_school": frame([("s1", "100"), ("s2", "200")], "school_id string, school_id_system string"),
        "dim_school_level_session": frame([("s1", "x1", True), ("s1", "x2", True), ("s1", "x9", False), ("s2", "y", False)],
                                          "school_id string, session_id string, active_status boolean"),
    }


def test_fact(spark):
    df = fact.build(fact_inputs(spark))
    assert df.columns == gold.COLUMNS[fact.TABLE] and len(df.columns) == 30
    rows = {(r.statement_id, r.response): r for r in df.collect()}
    assert set(rows) == {("1", "image"), ("1", "resp"), ("2", "r2"), ("3", None)}  # two results fan out, duplicates go
    first, second, plain, bare = rows["1", "image"], rows["1", "resp"], rows["2", "r2"], rows["3", None]
    assert (first.score_raw, first.success_status, first.text_response) == (None, False, "sr")
    assert (second.score_raw, second.success_status, second.text_response) == (2.5, True, "img")
    assert (first.session_id, first.session_active, first.attempts, first.activity_type) == ("x2", True, 3, "b")
    assert (first.learning_objective_id, first.learning_level_id, first.dt_time) == (None, "7", "t1")
    assert (plain.student_id, plain.student_code) == ("00000000-0000-1000-0000-123456789012", "1234567890123")
    assert (plain.session_id, plain.session_active, plain.attempts, plain.activity_type, plain.score_raw) == (None, False, 0, "", None)
    assert (bare.text_response, bare.student_id, bare.evaluable, bare.evaluated) == (None, None, 0, False)


def test_fact_plan_shuffles_each_big_table_once(spark, tmp_path):
    """When only the lookups are small: one exchange per statement-keyed input, none for the two distincts."""
    inputs = fact_inputs(spark)
    for name in [n for n in inputs if "lrs" in n]:
        wide = inputs[name].crossJoin(spark.range(2000)).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
        wide.drop("id").write.parquet(f"{tmp_path}/{name}")
        inputs[name] = spark.read.parquet(f"{tmp_path}/{name}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
        plan = fact.build(inputs)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 5
    assert plan.count("BroadcastExchange") == 2
    assert not any(word in plan for word in ("Cartesian", "NestedLoop", "Python"))


def test_fact_over_buckets_shuffles_no_keyed_table(spark, tmp_path):
    inputs = fact_inputs(spark)
    want = sorted(map(tuple, fact.build(inputs).collect()), key=str)
    wide = {}
    for name, df in inputs.items():
        wide[name] = df.crossJoin(spark.range(2000)).withColumn("pad", F.sha2(F.col("id").cast("string"), 256)).drop("id") if "lrs" in name else df
    kept = fact.keep(wide, "fact_in_buckets", str(tmp_path), 6)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
        built = fact.build(kept)
        plan = built._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") >= 5, plan
        small = fact.build(fact.keep(inputs, "fact_in_few_buckets", str(tmp_path), 3))
        assert sorted(map(tuple, small.collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(AnalysisException):
        fact.keep(inputs, "fact_in_few_buckets", str(tmp_path), 4)


# -- history --------------------------------------------------------------------------------------------------------
def test_history_reads_files_with_escapes_in_their_path(spark, tmp_path):
    for i, folder in enumerate(["dt=2024%3A00", "100%", "a+b c", "plain"]):
        row = spark.createDataFrame([(f"s{i}", "r")], "id_statement string, response string")
        row.coalesce(1).write.parquet(f"{tmp_path}/tmp{i}")
        (tmp_path / "results" / folder).mkdir(parents=True)
        part = next((tmp_path / f"tmp{i}").glob("*.parquet"))
        (tmp_path / "results" / folder / "f.parquet").write_bytes(part.read_bytes())
    objects = spark.createDataFrame([(f"s{i}", "choice") for i in range(4)], "id_statement string, interactionType string")
    objects.write.parquet(f"{tmp_path}/objects")
    done = spark.createDataFrame([], "path string")
    fresh = history.run(spark, f"{tmp_path}/results", f"{tmp_path}/objects", done, f"{tmp_path}/out", "history_paths")
    assert fresh.count() == 4
    assert sorted(r.statement_id for r in spark.table("history_paths.dim_lrs_result").collect()) == ["s0", "s1", "s2", "s3"]


def test_history_shuffles_results_once(spark, tmp_path):
    lines = [(f"s{i % 40}", f"r{i % 90}") for i in range(200)] + [(None, "r")] * 3
    results = spark.createDataFrame(lines, "id_statement string, response string")
    objects = spark.createDataFrame([(f"s{i}", "k") for i in range(30)] * 2 + [("s0", "m"), (None, "m")], "id_statement string, interactionType string")
    want = {name: sorted(map(str, df.drop("dt_load").collect())) for name, df in history.convert(results, objects).items()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        with history._dealt(results, objects, 200, "history_dealt") as targets:
            plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in targets.items()}
            assert plans["dim_lrs_result"].count("Exchange hashpartitioning") == 1  # of the objects
            assert "Exchange" not in plans["dim_lrs_result_scorm"]
            assert {name: sorted(map(str, df.drop("dt_load").collect())) for name, df in targets.items()} == want
            write_bucketed(targets["dim_lrs_result"], f"{tmp_path}/out", dealt=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    files = list((tmp_path / "out").glob("bucket=*/*.parquet"))
    assert len(files) == len(list((tmp_path / "out").glob("bucket=*")))  # one file a bucket folder, no task writes them all
    assert spark.sql("SHOW TABLES IN history_dealt").count() == 0


def test_history(spark):
    from learnlake.operators.shaping import EXCLUDED_STATEMENTS

    long_id = "é" * 200
    rows = [("s", long_id, "c", sid, ok) for sid, ok in [("1", "true"), ("1", "true"), (None, "x"), (EXCLUDED_STATEMENTS[0], "x"), ("2", "odd"), ("9", "true")]]
    results = spark.createDataFrame(rows, "id_sys string, lrs_id string, client_id string, id_statement string, success string")
    results = results.withColumn("scorm&46_response", F.lit("r"))
    objects = spark.createDataFrame([("1", "k"), ("1", "k"), ("2", "m"), (EXCLUDED_STATEMENTS[0], "k")], "id_statement string, interactionType string")
    out = history.convert(results, objects)
    result = out["dim_lrs_result"]
    assert rows_of(result, "statement_id", "success_status", "interaction_type", "response") == [
        ("1", True, "k", None), ("2", None, "m", None)
    ]
    assert {len(r.lrs_id) for r in result.collect()} == {128} and result.where("dt_load IS NULL").count() == 0
    assert result.columns == gold.COLUMNS["gold.dim_lrs_result"]
    assert rows_of(out["dim_lrs_result_scorm"], "statement_id", "response", "image") == [("1", "r", None), ("2", "r", None), ("9", "r", None)]
