"""Work that has to grow with the input: tasks of like size, no wide record dealt out twice, compressed archives."""

import glob
import os
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from learnlake.operators import joins
from learnlake.operators.shaping import spread
from learnlake.plans import lrs_batch
from learnlake.queries import io, learning
from learnlake.session import RUNTIME_CONF
from learnlake.sinks import archive, ledger
from learnlake.streaming import jobs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sizes(df):
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())


def test_spread_of_a_file_with_one_row_group(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(40_000).coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = spark.read.parquet(path)
        assert rows.rdd.getNumPartitions() >= 4  # but one of them has all rows
        assert sizes(rows) == [40_000]
        assert sizes(spread(rows, "id"))[-1] < 12_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_spread_makes_more_tasks_of_more_rows(spark, monkeypatch):
    monkeypatch.setattr("learnlake.operators.shaping.SPREAD", 1000)
    assert spread(spark.range(20_000), "id").rdd.getNumPartitions() == 20


def test_events_are_decoded_once_for_all_counts(spark, monkeypatch):
    times, make = spark.sparkContext.accumulator(0), learning._decoded

    def seen(n):
        times.add(1)
        return n

    count = F.udf(seen, "long").asNondeterministic()
    stamps = F.timestamp_seconds(F.col("id") + 1_700_000_000)
    events = spark.range(50).select(
        F.col("id").alias("event_id"), stamps.alias("ts"), (F.col("id") % 5).alias("user_id"), F.lit("click").alias("event_type"),
        F.lit(60.0).alias("value"), F.lit('{"k": 3}').alias("props"),
    )
    monkeypatch.setattr(learning, "_decoded", lambda t: make(t).where(count(F.length("payload").cast("long")) > 0))
    found = {r.table_name: r.n for r in learning.rows_per_target(SimpleNamespace(spark=spark, events=events)).collect()}
    assert found["gold.dim_lrs_verb"] == 50 and times.value == 50


def test_refresh_takes_each_path_once_and_keeps_no_event(spark):
    """The columns that the tables load from hold what each dimension selects from the raw rows."""
    event = '{"id": "e1", "lrsid": "l", "active": "true", "statement": {"verb": {"id": "v"}, "result": {"success": true}, ' \
        '"object": {"definition": {"extensions": {"%s": %s}}}}}'
    act = lrs_batch.normal_name(lrs_batch.ACT_TYPE)
    raw = spark.createDataFrame([(event % (act, '{"unitid": "u"}'),), (event % (act, "null"),), ("{}",)], "text string").select(
        F.parse_json("text").alias("event"), F.lit("2024-01-01").cast("timestamp").alias("dt_load")
    )
    rows = lrs_batch.flat(raw)
    assert "event" not in rows.columns and len(rows.columns) == len(set(lrs_batch._FLAT)) + 2
    for name in lrs_batch.DIMENSIONS:
        own, kept = lrs_batch.dimension(raw, name), lrs_batch.flat_dimension(rows, name)
        assert own.schema == kept.schema and sorted(own.collect(), key=repr) == sorted(kept.collect(), key=repr)
    assert lrs_batch.flat_dimension(rows, "dim_lrs_object_http").count() == 1


def test_stages_are_compiled_and_files_are_small(spark):
    assert RUNTIME_CONF["spark.sql.codegen.hugeMethodLimit"] == "8000"
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"


def test_archives_are_compressed_and_read_back(spark, tmp_path):
    rows = spark.range(1000, numPartitions=4).select(F.lit("same text " * 50).alias("payload"), F.lit("01").alias("month"))
    for dealt in (True, False):
        archive.write_json(rows, str(tmp_path / f"a{dealt}"), ["month"], dealt=dealt)
        assert all(f.endswith(".json.gz") for f in glob.glob(f"{tmp_path}/a{dealt}/month=01/part*"))
        assert spark.read.schema("payload string").json(str(tmp_path / f"a{dealt}")).where("length(payload) = 500").count() == 1000
    assert len(glob.glob(f"{tmp_path}/aFalse/month=01/part*")) == 4  # written by the tasks that made them
    archive.write_failed(rows, str(tmp_path / "failed"), "a.b", "insert", "1")
    assert glob.glob(f"{tmp_path}/failed/insert_a_b/batch=1/*.json.gz")


def test_records_become_a_file_a_task_and_two_batches(spark, tmp_path):
    batches = []
    records = spark.range(100, numPartitions=6).toDF("n")
    stream = io._record_stream(SimpleNamespace(spark=spark), records)
    stream, file = stream.select("n", F.col("_metadata.file_path").alias("file")), F.count_distinct("file")
    jobs.start(stream, lambda df, i: batches.append(tuple(df.agg(file, F.count("n")).first())), str(tmp_path / "cp")).awaitTermination()
    assert [f for f, _ in batches] == [3, 3] and sum(n for _, n in batches) == 100


def test_parts_are_batches_and_a_batch_is_read_once(spark, tmp_path):
    batches, times = [], spark.sparkContext.accumulator(0)

    def seen(n):
        times.add(1)
        return n

    count = F.udf(seen, "long").asNondeterministic()

    def write(df, batch):
        assert df.storageLevel.useMemory
        batches.append((batch, df.count(), df.agg(F.sum("n")).first()[0]))

    parts = [spark.range(a, a + 10, numPartitions=3).toDF("n") for a in (0, 5, 10)]
    io._stream_of_parts(
        SimpleNamespace(spark=spark), parts,
        lambda stream, cp: jobs.start(stream.select(count("n").alias("n")), jobs.read_once(write), cp),
    )
    assert batches == [(0, 10, 45), (1, 10, 95), (2, 10, 145)]
    assert times.value == 30


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(io.fact, "BUCKET_ROWS", 100)
    monkeypatch.setattr(io, "fact_tables", lambda t: {})
    monkeypatch.setattr(io.fact, "keep", lambda given, database, out, n: asked.append(n))
    monkeypatch.setattr(io.fact, "build", lambda given: None)
    io.fact_over_buckets(SimpleNamespace(spark=spark, lineitem=spark.range(5000)))
    assert asked == [50]


def test_object_files_are_taken_by_thousands(spark, tmp_path, monkeypatch):
    """A file of 64 events is 0.1 MB: a hundred of them are no batch."""
    asked = []
    follow = io.files.follow_documents
    monkeypatch.setattr(io.files, "follow_documents", lambda s, p, n=None: asked.append(n) or follow(s, p, n))
    stamps = F.timestamp_seconds(F.col("id") + 1_700_000_000)
    events = spark.range(300).select(
        F.col("id").alias("event_id"), stamps.alias("ts"), (F.col("id") % 5).alias("user_id"), F.lit("click").alias("event_type"),
        F.lit(60.0).alias("value"), F.lit('{"k": 3}').alias("props"),
    )
    rows = io.stream_object_files(SimpleNamespace(spark=spark, events=events)).collect()
    assert len({r["id"] for r in rows if r["name"] != "objects"}) == 300 and len(rows) == 305
    assert asked[0] >= 1000 and asked[1] is None


def test_many_log_rows_are_not_collected_for_a_broadcast(spark, monkeypatch):
    """The files of the log are a few bytes a row; in memory a row of it takes over 400."""
    events = spark.range(300).select(F.col("id").alias("event_id"), (F.col("id") % 5).alias("user_id"), F.lit("2024-01-01").cast("timestamp").alias("ts"))
    t = SimpleNamespace(spark=spark, events=events)
    assert "SortMergeJoin" not in plan(io.archive_raw(t))
    monkeypatch.setattr(joins, "FEW", 299, raising=False)
    rows = io.archive_raw(t)
    assert "SortMergeJoin" in plan(rows) and "BroadcastExchange" not in plan(rows)
    found = {(r.payload.split('"')[3], r.partition_key, r.sequence_number[-3:]) for r in rows.collect()}
    assert found == {(f"ev{i}", str(i % 5), f"{i:03}") for i in range(300)} and rows.count() == 300


def test_many_known_records_are_not_collected_for_a_broadcast(spark, tmp_path, monkeypatch):
    """A new epoch leaves out what a sealed one took, also records without identity, by a broadcast of few or a shuffle of many."""
    rows = [(str(i % 3), str(i)) for i in range(20)] + [(None, "x"), ("y", None), (None, None)]
    batch = lambda part: spark.createDataFrame(part, "shard string, number string").withColumn("wide", F.lit("w"))
    identity = (F.col("shard"), F.col("number"), F.lit("2024-01-01").cast("timestamp"))
    for few, kind in ((100, "BroadcastHashJoin"), (5, "SortMergeJoin")):
        out = str(tmp_path / kind)
        monkeypatch.setattr(joins, "FEW", few, raising=False)
        for number in (0, 1):  # the second batch was not committed
            ledger.fresh(ledger.Commit(out, number, 0, {}), batch(rows[:8] + rows[-3:-1] if number == 0 else rows[8:12]), *identity)
        left = ledger.fresh(ledger.Commit(out, 0, 1, {0: 0}), batch(rows), *identity)
        assert kind in plan(left) and ("BroadcastExchange" in plan(left)) == (few == 100)
        assert sorted(left.collect(), key=repr) == sorted(batch(rows[8:20] + rows[-1:]).collect(), key=repr)


def test_object_files_are_those_of_sparks_writer_without_a_process_each(spark, tmp_path):
    names = [f"a+{i}" for i in range(40)] + ["x%y:z=1", "é ü", None]
    rows = spark.createDataFrame([(n, f"té\nxt {n}") for n in names], "part string, value string").repartition(3)
    rows.write.partitionBy("part").text(f"{tmp_path}/spark")
    for _ in range(2):  # a repeated task replaces its files
        archive.write_objects(rows, f"file://{tmp_path}/own", "part")
    read = lambda p: sorted(
        (r.path.split("part=")[1].split("/")[0], r.payload) for r in io.files.json_documents(spark, f"{tmp_path}/{p}").collect()
    )
    assert read("own") == read("spark") and len(read("own")) == len(names)
    assert len(glob.glob(f"{tmp_path}/own/part=*/{'[!_]'}*")) == len(names) and not glob.glob(f"{tmp_path}/own/part=*/.*")


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(450):
        (tmp_path / f"part=a+{i}").mkdir()
        (tmp_path / f"part=a+{i}" / "object.txt").write_text("[]")
    tracker, group = spark.sparkContext.statusTracker(), "listing"
    spark.sparkContext.setJobGroup(group, group)
    try:
        documents = io.files.json_documents(spark, str(tmp_path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert max(i.numTasks for i in map(tracker.getStageInfo, stages) if i) <= 200
    assert documents.count() == 450


def test_a_later_epoch_reads_its_records_once_to_note_them(spark, tmp_path):
    times = spark.sparkContext.accumulator(0)

    def seen(n):
        times.add(1)
        return n

    records = spark.range(30).select(F.udf(seen, "string").asNondeterministic()(F.col("id").cast("string")).alias("number"))
    identity = (F.lit("s"), F.col("number"), F.timestamp_seconds(F.col("number").cast("long")))
    ledger.fresh(ledger.Commit(str(tmp_path), 0, 0, {}), records.where("number < 10"), *identity)
    times.value = 0
    assert ledger.fresh(ledger.Commit(str(tmp_path), 0, 1, {0: 0}), records, *identity) is not records
    assert times.value == 30


ENVELOPE = "eventSource string, eventVersion string, eventID string, awsRegion string, partitionKey string, sequenceNumber string, " \
    "data string, approximateArrivalTimestamp double"


def record(n, data="e30="):
    return ("aws:kinesis", "1.0", f"s:{n}", "r", "p", str(n), data, float(n))


def test_a_decoded_batch_is_staged_in_files_not_in_memory(spark, tmp_path, monkeypatch):
    """Its wide rows took what memory the executors had; the files are gone with the batch, also if it fails."""
    seen, write = [], jobs._log_and_archive

    def looked_at(job, events, decoded, out, batch_id):
        seen.append((decoded.storageLevel.useMemory, decoded.inputFiles(), decoded.count()))
        write(job, events, decoded, out, batch_id)
        if batch_id:
            raise RuntimeError("full")

    monkeypatch.setattr(jobs, "_log_and_archive", looked_at)
    records = spark.createDataFrame([record(1), record(2), record(3, "e30"), record(4, None)], ENVELOPE)
    assert {s for s, _ in jobs.run_batch(jobs.LEARNING, records, 0, str(tmp_path)).values()} == {"ok"}
    with pytest.raises(RuntimeError, match="full"):
        jobs.run_batch(jobs.LEARNING, records, 1, str(tmp_path))
    for in_memory, files, n in seen:
        assert not in_memory and files and n == 4
        assert not any(os.path.exists(urlparse(f).path) for f in files)


def test_the_state_of_a_stream_is_not_in_the_heap(spark, tmp_path):
    for i in range(2):
        spark.createDataFrame([record(1), record(i + 2)], ENVELOPE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.deliver_once(jobs.source(spark, f"{tmp_path}/in", spark.createDataFrame([], ENVELOPE).schema, "parquet", 1))
    got = []
    query = jobs.start(stream, lambda df, i: got.extend(r.sequenceNumber for r in df.collect()), f"{tmp_path}/cp")
    query.awaitTermination()
    assert sorted(got) == ["1", "2", "3"]
    metrics = [s["customMetrics"] for p in query.recentProgress for s in p["stateOperators"]]
    assert metrics and all(any(k.startswith("rocksdb") for k in m) for m in metrics)
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage") == "true"
    assert int(spark.conf.get("spark.sql.inMemoryColumnarStorage.batchSize")) <= 1000
