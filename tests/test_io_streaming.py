import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from learnlake.operators import incremental, reports
from learnlake.schemas import gold
from learnlake.schemas.events import IDS, VERB_PREFIX
from learnlake.session import scratch_path, written
from learnlake.sinks import archive, merge, tables
from learnlake.sources import files, jdbc
from learnlake.streaming import jobs, progress

ENVELOPE = """eventSource string, eventVersion string, eventID string, awsRegion string, partitionKey string,
    sequenceNumber string, data string, approximateArrivalTimestamp double"""


def record(number, payload, arrived=1.0):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return ("aws:kinesis", "1.0", f"shard-1:{number}", "r", "p", str(number), base64.b64encode(text.encode()).decode(), arrived)


def learning(n, verb):
    body = {"id": f"e{n}", "lrs_id": "l", "verbID": VERB_PREFIX + verb, "statement": {
        "id": f"s{n}", "result": {"completion": True}, "object": {"definition": {"extensions": {IDS: {"rolId": str(n)}}}}}}
    return record(n, body)


# -- files ----------------------------------------------------------------------------------------------------------
def test_profile_json(spark, tmp_path):
    contents = {
        "array.json": "[1, 2, 3]", "pretty_array.json": '[\n {"a": 1},\n {"a": 2}\n]', "object.json": '{"a": 1}',
        "pretty.json": '{\n"a": [\n1\n]}\n', "lines.json": '{"a": 1}\n\n{"b": 2}\nbroken\n[1]\n', "bad_first.json": 'broken\n{"a": 1}\n{"a": 2}',
        "broken.json": "{", "empty.json": "", "scalar.json": "5", "empty_array.json": "[]",
    }
    folder = tmp_path / "in" / "sub"
    folder.mkdir(parents=True)
    for name, content in contents.items():
        (folder / name).write_text(content)
    (folder / "other.txt").write_text("[1]")
    counts = files.profile_json(spark, str(tmp_path / "in"))
    got = {r.path.split("/")[-1]: r.records for r in counts.collect()}
    assert got | {"empty.json": 0} == {
        "array.json": 3, "pretty_array.json": 2, "object.json": 1, "pretty.json": 1, "lines.json": 3, "bad_first.json": 2,
        "broken.json": 0, "empty.json": 0, "scalar.json": 1, "empty_array.json": 0,
    }
    assert files.largest(counts).first()["path"].endswith("/array.json")


def test_json_documents_decode_names(spark, tmp_path):
    (tmp_path / "a b.json").write_text('{"x":\n 1}')
    (tmp_path / "c.json").write_text("nope")
    rows = files.json_documents(spark, str(tmp_path)).orderBy("path").collect()
    assert [r.path.split("/")[-1] for r in rows] == ["a b.json", "c.json"]
    assert rows[0].doc is not None and rows[1].doc is None


def test_history_folders_and_resume(spark, tmp_path):
    base = str(tmp_path)
    for owner, year in (("7449", "2024"), ("7449", "2025"), ("896", "2024")):
        spark.createDataFrame([(owner + year,), (owner + year,)], "id string").coalesce(1).write.parquet(files.history_path(base, owner, year))
    rows = files.history(spark, base, ["7449"], ["2024", "2025"], "results")
    assert rows_of(rows.distinct()) == [("74492024", "7449", "2024"), ("74492025", "7449", "2025")]
    assert files.load_distinct(spark, files.history_path(base, "896", "2024")).count() == 1
    listed = files.listing(spark, base)
    assert listed.count() == 3 and files.pending(spark, base, listed.limit(2)).count() == 1


def test_jdbc_pushes_the_query(monkeypatch):
    """Options only: no database is contacted."""
    seen = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def load(self):
            return seen

    class Session:
        read = Reader()

    jdbc.read_query(Session(), {"url": "u"}, "SELECT 1", "id", (0, 9), 3)
    assert seen == {"url": "u", "dbtable": "(SELECT 1) AS pushed", "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}


# -- tables ---------------------------------------------------------------------------------------------------------
def test_csv_dialect(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [
        (1, 'say "x"', True), (2, "line1\nline2", None), (3, "back\\slash\\", False), (4, None, None), (5, '\\"', True),
        (6, "a\r\nb\rc", True), (7, ',",\n",', False), (8, "\\N", True),
    ]
    df = spark.createDataFrame([*rows, (9, " ", None)], "n int, s string, b boolean")
    tables.write_csv(df, path)
    wanted = [r for r in rows if r[0] != 8] + [(8, None, True), (9, None, None)]  # the loader's mark for no value
    assert rows_of(tables.load_csv(spark, path, df.schema)) == sorted(wanted, key=repr)
    (tmp_path / "csv" / "bad.csv").write_text("x,y,z\n" * 3)
    assert tables.load_csv(spark, path, df.schema, 3).count() == 9
    parked = spark.read.schema("value string").json(f"{path}-rejected")
    assert [r.value for r in parked.collect()] == ["x,y,z"] * 3
    with pytest.raises(ValueError):
        tables.load_csv(spark, path, df.schema, 2, str(tmp_path / "parked"))
    assert spark.read.json(str(tmp_path / "parked")).count() == 3


def test_replace_only_when_there_are_rows(spark):
    base = scratch_path(spark, "guard")
    df = spark.range(3)
    assert not tables.replace_if_any(spark, df.where("id > 9"), "guarded", base)
    assert not spark.catalog.tableExists("guarded")
    assert tables.replace_if_any(spark, df, "guarded", base)
    assert not tables.replace_if_any(spark, df.where("id > 9"), "guarded", base)
    assert spark.table("guarded").count() == 3
    tables.replace_table(spark, spark.table("guarded").where("id > 0"), "guarded", base, last_batch="7")
    assert spark.table("guarded").count() == 2 and tables.table_property(spark, "guarded", "last_batch") == "7"


def test_bucketed_write_and_load(spark):
    path = scratch_path(spark, "buckets")
    df = spark.range(1000).select(F.col("id").cast("string").alias("statement_id"), F.col("id").alias("v"))
    tables.write_bucketed(df, path, n=7)
    back = spark.read.parquet(path)
    assert back.count() == 1000 and back.select("bucket").distinct().count() == 7
    for _ in range(2):  # a repeated run adds nothing
        tables.write_bucketed(df, f"{path}-t/run=1", n=7, mode="overwrite")
        tables.load_folder(spark, f"{path}-t/run=1", "loaded", df.schema, f"{path}-t", "1")
    assert spark.table("loaded").count() == 1000 and spark.table("loaded").columns == ["statement_id", "v", "run", "bucket"]


def test_written_cuts_lineage(spark):
    df = written(spark.range(5).withColumn("x", F.rand()), "w")
    assert "rand" not in df._jdf.queryExecution().executedPlan().toString() and df.collect() == df.collect()


# -- incremental ----------------------------------------------------------------------------------------------------
def test_window_and_marks(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    df = spark.createDataFrame([(day(n),) for n in (1, 2, 3)], "dt_load timestamp")
    assert incremental.window(df, "dt_load", day(1), day(3)).count() == 2
    assert incremental.window(df, "dt_load").count() == 3
    assert incremental.last_loaded(spark, "no_such_table") == dt.datetime(2000, 1, 1)
    tables.replace_table(spark, df, "marked", scratch_path(spark, "marked"))
    assert incremental.last_loaded(spark, "marked") == day(3)
    tables.replace_table(spark, df.where("false"), "marked", scratch_path(spark, "marked"))
    assert incremental.last_loaded(spark, "marked") == dt.datetime(2000, 1, 1)
    for upto in (1, 3, 2):
        incremental.save_progress(spark, "control", scratch_path(spark, "control"), ["marked", "other"], day(upto))
    assert rows_of(incremental.progress(spark, "control")) == [("marked", day(3)), ("other", day(3))]


def test_reports(spark):
    df = spark.createDataFrame([("a", "b", True, 5), ("a", "a", True, 7), ("c", "c", False, None)], "t string, s string, ok boolean, ms int")
    assert rows_of(reports.target_vs_actual(df, F.col("t"), F.col("s"), F.col("ok"))) == [("a", 2, 1, 50.0), ("b", 0, 1, None), ("c", 1, 0, 0.0)]
    assert rows_of(reports.success_counts(df, F.col("ok"), ["t"])) == [("a", 2, 2, 0, 100.0), ("c", 1, 0, 1, 0.0)]
    assert rows_of(reports.latency(df, F.col("ms"))) == [(6.0, 5, 7, 2)]
    assert rows_of(reports.throughput(df, F.col("ms"))) == [(3, 2, 1.5)]
    assert reports.has_rows(spark.range(50)) == 10 and reports.has_rows(spark.range(0)) == 0


def test_refresh_isolates_a_failing_table(spark, docs):
    from learnlake.plans import lrs_batch

    raw = docs({"id": "1"}, {"id": "2"}).select(F.col("doc").alias("event"), F.timestamp_seconds(F.col("n") + 10**9).alias("dt_load"))
    base = scratch_path(spark, "refresh")
    spark.sql("CREATE DATABASE refresh_test")
    wrong = spark.createDataFrame([], "dt_load timestamp").schema
    tables.register(spark, "refresh_test.dim_lrs_actor", f"{base}/wrong", wrong)
    for expected in (1, 2, 2):
        upto = F.timestamp_seconds(F.lit(10**9 + min(expected, 2) - 1))
        summary = {r.table_name: (r.n, r.status) for r in lrs_batch.refresh(spark, raw, "refresh_test", base, upto).collect()}
        assert summary["dim_lrs_actor"] == (0, "failed") and summary["TOTAL"][1] == "failed"
        assert summary["dim_lrs_verb"][1] == "ok" and spark.table("refresh_test.dim_lrs_verb").count() == expected
    assert spark.table("refresh_test.dim_lrs_object_http").count() == 0
    assert incremental.progress(spark, "refresh_test.load_progress").count() == 8


# -- streaming ------------------------------------------------------------------------------------------------------
def test_stream_equals_batch_and_repeats_add_nothing(spark):
    rows = [learning(i, v) for i, v in enumerate(["answered", "terminated", "experienced", "attempted", "completed"] * 4)]
    rows += [record(90, "not json"), record(91, {"id": "no verb"})]
    records = spark.createDataFrame(rows, ENVELOPE)
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "out")
    records.repartition(3).write.json(inbox)
    stream = jobs.source(spark, inbox, records.schema, "json", 1)
    handler = lambda df, i: jobs.run_batch(jobs.LEARNING, df, i, out)
    jobs.start(stream, handler, scratch_path(spark, "cp")).awaitTermination()
    batches = spark.read.parquet(f"{out}/tables/gold.dim_lrs_statement").select("batch").distinct().count()
    assert batches == 3
    once = scratch_path(spark, "once")
    status = jobs.run_batch(jobs.LEARNING, records, 0, once)
    assert set(status.values()) == {("ok", None)}
    jobs.run_batch(jobs.LEARNING, records, 0, once)
    for table, build in jobs.LEARNING.targets.items():
        columns = [c for c in gold.data_columns(table)]
        streamed, batch = (spark.read.parquet(f"{o}/tables/{table}") for o in (out, once))
        assert rows_of(streamed, *columns) == rows_of(batch, *columns)
        assert batch.where("dt_load IS NULL").count() == 0
    assert spark.read.parquet(f"{once}/tables/infrastructure.kinesis_log").count() == 21
    assert spark.read.json(f"{once}/unknown").count() == 5
    rejected = spark.read.json(f"{once}/rejected/*/")
    assert [r.error for r in rejected.collect()] == ["not JSON"]
    logged = spark.read.parquet(f"{once}/tables/infrastructure.kinesis_log").where("sequence_number = '3'").first()
    archived = spark.read.json(logged.s3_uri).where(F.col("sequenceNumber") == "3").collect()  # the folder opens
    assert [(r.partitionKey, json.loads(r.payload)["id"]) for r in archived] == [("p", "e3")]


def test_a_failing_table_is_retried_then_parked(spark):
    calls = []

    def flaky(events):
        calls.append(1)
        return events.select(F.raise_error(F.lit("boom")).cast("string").alias("id_system"))

    job = jobs.Job("learning", {"gold.dim_lrs_verb": jobs.LEARNING.targets["gold.dim_lrs_verb"]}, jobs.LEARNING.route, layout=archive.learning_layout)
    out = scratch_path(spark, "park")
    parked = []
    status, error = jobs.attempt(lambda: calls.append(2) or 1 / 0, lambda: parked.append(1))
    assert (status, len(calls), parked) == ("failed", 3, [1]) and "ZeroDivision" in error
    good = spark.createDataFrame([learning(1, "answered")], ENVELOPE)
    blocked = f"{out}/tables/gold.dim_lrs_verb"
    import pathlib

    pathlib.Path(blocked).parent.mkdir(parents=True)
    pathlib.Path(blocked).write_text("a file where a folder should be")
    result = jobs.run_batch(job, good, 4, out)
    assert result["gold.dim_lrs_verb"][0] == "failed"
    parked_rows = spark.read.json(f"{out}/errors/insert_gold_dim_lrs_verb/batch=4")
    assert parked_rows.first().statement_id == "s1"


def admin(number, action, entity="USER", arrived=None, **attributes):
    body = {"meta": {"action": action, "entityKey": entity}, "data": {"attributes": attributes}}
    return record(number, body, arrived if arrived is not None else float(number))


def test_change_job(spark):
    out = scratch_path(spark, "changes")
    name = lambda n: {"firstName": n}
    first = [
        admin(1, "user_updated", refId="a", name=name("A1")), admin(3, "user_updated", refId="a", name=name("A3")),
        admin(2, "user_updated", refId="a", name=name("A2")), admin(4, "user_updated", refId="b", name=name("B")),
        admin(5, "user_created", refId="z", name=name("Z")), admin(6, "user_updated", "ARTICLE", refId="q"),
        admin(7, "user_updated", "OTHER", refId="q"), admin(8, "user_updated", name=name("no key")),
        admin(9, "x_updated", "USERSCHOOLCLASS", schoolClass={"refId": "k"}, userList=[{"personRefId": "p"}, {"personRefId": "q"}]),
    ]
    second = [
        admin(11, "user_deleted", refId="a"), admin(12, "user_updated", refId="c", name=name("C")),
        admin(13, "user_deleted", refId="c"), admin(14, "user_updated", refId="c", name=name("C2")),
        admin(15, "x_deleted", "USERSCHOOLCLASS", schoolClass={"refId": "k"}, userList=[{"personRefId": "q"}]),
        admin(10, "user_deleted", refId="b", arrived=20.0), admin(16, "user_updated", refId="b", arrived=19.0, name=name("late")),
    ]
    only = {t: jobs.ADMIN_CHANGES.targets[t] for t in ("gold.dim_user", "gold.dim_user_phone", "gold.dim_class_participant")}
    job = jobs.Job("admin", only, jobs.ADMIN_CHANGES.route, jobs.ADMIN_CHANGES.admit, jobs.ADMIN_CHANGES.layout, jobs.ADMIN_CHANGES.folders)
    users = lambda: rows_of(merge.read(spark, "change_test.dim_user"), "user_id", "first_name")
    for _ in range(2):
        status = jobs.run_change_batch(job, spark.createDataFrame(first, ENVELOPE), 0, out, database="change_test")
        assert {s for s, _ in status.values()} == {"ok"}
        assert users() == [("a", "A3"), ("b", "B")]
    jobs.run_change_batch(job, spark.createDataFrame(second, ENVELOPE), 1, out, database="change_test")
    assert users() == [("c", "C2")]
    phones = merge.read(spark, "change_test.dim_user_phone")
    assert rows_of(phones, "user_phone_id") == [("c",)]  # child rows go with their parent
    members = merge.read(spark, "change_test.dim_class_participant")
    assert rows_of(members, "user_id", "section_id") == [("p", "k")]
    assert members.where("dt_load IS NULL").count() == 0
    assert spark.read.json(f"{out}/unknown/batch=0").count() == 1
    assert spark.read.parquet(f"{out}/tables/infrastructure.kinesis_log").count() == 7 + 7


def test_late_records(spark):
    now = dt.datetime(2024, 1, 1, 12)
    ages = [0, 299, 300, 301, 9999]
    rows = [(a, now - dt.timedelta(seconds=a)) for a in ages] + [(-1, None)]
    on_time, late = jobs.split_late(spark.createDataFrame(rows, "age int, t timestamp"), F.col("t"), F.lit(now))
    assert rows_of(on_time, "age") == [(-1,), (0,), (299,), (300,)] and rows_of(late, "age") == [(301,), (9999,)]


def test_raw_ingest_parks_and_replays(spark):
    out, now = scratch_path(spark, "raw"), F.timestamp_seconds(F.lit(1000))
    rows = [(i, "answered" if i % 2 else "other", 600.0 if 3 <= i <= 6 and i != 5 else 900.0) for i in range(10)]
    log = spark.createDataFrame([record(i, {"id": f"e{i}", "verbID": VERB_PREFIX + v}, at) for i, v, at in rows] + [record(99, "no json", 900.0)], ENVELOPE)
    for _ in range(2):
        jobs.run_raw_batch(log, 0, out, now=now)
    raw = lambda: rows_of(spark.read.parquet(f"{out}/raw_tables").select("batch", F.col("event").cast("string").alias("e")), "batch", "e")
    assert len(raw()) == 7
    notice = spark.read.parquet(f"{out}/notices").first()
    assert (notice.start_sequence, notice.end_sequence) == ("3", "6")
    for _ in range(2):
        jobs.replay_raw(log, out)
    assert sorted(json.loads(e)["id"] for b, e in raw() if b.startswith("replay-")) == ["e3", "e4", "e6"] and len(raw()) == 10
    kept = spark.read.parquet(f"{out}/raw_tables").groupBy("table_name").count().collect()
    assert {r.table_name: r["count"] for r in kept} == {"lrs_events_answered": 5, "lrs_events_all": 5}
    # a later replay, after more notices and from a log that no longer has the earlier records, adds to the first one
    later = spark.createDataFrame([record(i, {"id": f"e{i}", "verbID": VERB_PREFIX + "answered"}, 600.0) for i in (20, 21)], ENVELOPE)
    jobs.run_raw_batch(later, 1, out, now=now)
    for _ in range(2):
        jobs.replay_raw(later, out)
    assert sorted(json.loads(e)["id"] for b, e in raw() if b.startswith("replay-")) == ["e20", "e21", "e3", "e4", "e6"]
    dropped = scratch_path(spark, "dropped")
    jobs.run_raw_batch(log, 0, dropped, now=now, unknown=None)
    assert spark.read.parquet(f"{dropped}/raw_tables").count() == 4


def test_refresh_marks_and_day_filter(spark, docs):
    from learnlake.plans import lrs_batch

    raw = docs(*[{"id": str(i)} for i in range(6)]).select(F.col("doc").alias("event"), F.timestamp_seconds(F.col("n") * 86400).alias("dt_load"))
    base = scratch_path(spark, "days")
    tables.append_raw(raw.withColumn("table_name", F.lit("t")), f"{base}/raw")
    stored = spark.read.parquet(f"{base}/raw")
    rows = lrs_batch.window_rows(stored, F.timestamp_seconds(F.lit(86400 * 2)), F.timestamp_seconds(F.lit(86400 * 4)))
    assert rows.count() == 2 and "PartitionFilters: [isnotnull(load_date" in rows._jdf.queryExecution().executedPlan().toString()
    spark.sql("CREATE DATABASE marks_test")
    tables.register(spark, "marks_test.dim_lrs_verb", f"{base}/verb", spark.createDataFrame([], "dt_load timestamp").schema)
    day = lambda n: dt.datetime(2024, 1, n)
    incremental.save_progress(spark, "marks_test.p", base, ["dim_lrs_verb"], day(3))
    mark = lambda: lrs_batch.marks(spark, "marks_test", "marks_test.p")["dim_lrs_verb"]
    assert mark() == day(3)
    spark.createDataFrame([(day(2),), (day(5),)], "dt_load timestamp").write.insertInto("marks_test.dim_lrs_verb")
    assert mark() == day(5)  # a load that was not recorded


def test_refresh_reads_raw_rows_that_appear_late(spark, docs):
    """Files that appear after a refresh with a load time below its upto, or just before it, are read by the next one."""
    from learnlake.plans import lrs_batch

    at = lambda n: F.timestamp_seconds(F.lit(10**9 + n))
    event = lambda i, when: docs({"id": i}).select(F.col("doc").alias("event"), when.alias("dt_load"), F.lit("t").alias("table_name"))
    base = scratch_path(spark, "late")
    tables.append_raw(event("1", at(0)), f"{base}/raw")
    load = lambda upto: lrs_batch.refresh(spark, spark.read.parquet(f"{base}/raw"), "late_test", base, upto).collect()
    ids = lambda: sorted(r.statement_id for r in spark.table("late_test.dim_lrs_verb").collect())
    load(at(100))
    tables.append_raw(event("2", at(50)), f"{base}/raw")
    tables.append_raw(event("3", F.current_timestamp()), f"{base}/raw")
    load(F.current_timestamp())
    assert ids() == ["1", "2"]
    tables.append_raw(event("4", F.current_timestamp() - F.expr("INTERVAL 1 HOUR")), f"{base}/raw")
    load(F.current_timestamp())
    assert ids() == ["1", "2", "4"]
    marks = {r.table_name: r.last_processed for r in incremental.progress(spark, "late_test.load_progress").collect()}
    assert marks["dim_lrs_object_http"] == dt.datetime(2000, 1, 1) and len(marks) == 9


def test_archives(spark):
    path = scratch_path(spark, "failed")
    archive.write_failed(spark.range(2), path, "gold.dim_user", "upsert", "3")
    assert spark.read.json(f"{path}/upsert_gold_dim_user/batch=3").count() == 2


# -- object files and counters ---------------------------------------------------------------------------------------
def test_object_files_of_all_kinds(spark, tmp_path):
    """One event, a list of them, an empty list, what is not JSON, an empty file; a file that changes is loaded again."""
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    event = lambda n: {"Verb_ID": VERB_PREFIX + "answered", "id": n}
    for name, text in {"a+b.json": json.dumps(event("1")), "c d.json": json.dumps([event("2"), event("3")]), "e.json": "[]", "f.json": "{", "g": ""}.items():
        (inbox / name).write_text(text)
    drain = lambda cp: jobs.start(
        files.follow_documents(spark, str(inbox), 2), lambda df, i: jobs.run_object_batch(df, i, out), str(tmp_path / cp)
    ).awaitTermination()
    drain("cp")
    drain("cp")
    (inbox / "a+b.json").write_text(json.dumps(event("4")))
    os.utime(inbox / "a+b.json", (2_000_000_000, 2_000_000_000))
    drain("cp2")
    got = jobs.raw_tables(spark, out).selectExpr("table_name", "variant_get(event, '$.id', 'string') AS id").collect()
    assert sorted(map(tuple, got)) == [("lrs_events_answered", i) for i in "1234"]
    listed = spark.read.parquet(f"{out}/objects").selectExpr("element_at(split(path, '/'), -1) AS name", "events").collect()
    assert sorted(map(tuple, listed)) == [("a+b.json", 1), ("a+b.json", 1), ("c d.json", 2), ("e.json", 0), ("f.json", 0)]
    rejected = spark.read.json(f"{out}/rejected/decode_objects").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in rejected) == ["f.json"]


def test_counters_of_a_stream(spark, tmp_path):
    schema = "shard string, ok boolean, s double"
    for i, rows in enumerate([[("a", True, 1.0), ("a", None, 3.0), (None, False, 2.0)], [("a", True, 9.0), ("z", True, 4.0)], []]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = progress.ProgressTable(spark, str(tmp_path / "progress"))
    try:
        stream = progress.counted(jobs.source(spark, str(tmp_path / "in"), schema, "parquet", 1), F.col("ok"), F.col("shard"), ["a", "b"], F.col("s"))
        sink = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
        table.wait(sink.start(str(tmp_path / "out")))
    finally:
        table.close()
    got = {r.shard: (r.total, r.ok, r.failed, r.elapsed_s, r.per_second) for r in progress.success_counts(table.read()).collect()}
    assert got == {"a": (3, 2, 1, 8.0, 3 / 8), None: (2, 1, 1, 2.0, 1.0)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
