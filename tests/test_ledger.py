"""Runs that lose their checkpoint, fail half-way or are replaced while they are alive."""

import json

import pytest
from pyspark.sql import functions as F

from learnlake.schemas import gold
from learnlake.session import scratch_path
from learnlake.sinks import ledger, merge
from learnlake.streaming import jobs
from test_io_streaming import ENVELOPE, learning, record


@pytest.fixture
def as_query(spark):
    """Calls a handler as a streaming query with the given id would."""

    def call(query, handler, *args):
        spark.sparkContext.setLocalProperty(ledger.QUERY_ID, query)
        try:
            return handler(*args)
        finally:
            spark.sparkContext.setLocalProperty(ledger.QUERY_ID, None)

    return call


def raw_ids(spark, out):
    rows = jobs.raw_tables(spark, out).select(F.expr("variant_get(event, '$.id', 'string')").alias("id")).collect()
    return sorted(r.id for r in rows)


def ingest_into(out):
    return lambda df, i: jobs.run_raw_batch(df, i, out, now=F.lit("1970-01-01").cast("timestamp"))  # nothing is late


def test_a_new_checkpoint_loads_what_is_missing_and_nothing_twice(spark, as_query):
    out = scratch_path(spark, "ledger")
    batch = lambda *n: spark.createDataFrame([learning(i, "answered") for i in n], ENVELOPE)
    ingest = ingest_into(out)
    as_query("a", ingest, batch(1, 2), 0)
    as_query("a", ingest, batch(3), 1)
    as_query("a", ingest, batch(3), 1)  # tried again after its commit
    as_query("b", ingest, batch(1, 2, 3, 4), 0)
    as_query("b", ingest, batch(5), 1)
    as_query("c", ingest, batch(1, 2, 3, 4, 5, 6), 0)
    assert raw_ids(spark, out) == [f"e{i}" for i in range(1, 7)]
    with pytest.raises(ledger.Fenced):
        as_query("a", ingest, batch(9), 2)
    with pytest.raises(ledger.Fenced):
        as_query("b", ingest, batch(9), 2)


def test_a_batch_that_never_committed_is_invisible_and_loaded_by_the_next_run(spark, as_query, monkeypatch):
    out = scratch_path(spark, "ledger")
    batch = lambda *n: spark.createDataFrame([learning(i, "answered") for i in n], ENVELOPE)
    ingest = ingest_into(out)
    as_query("a", ingest, batch(1), 0)
    with monkeypatch.context() as m:
        m.setattr(ledger, "finish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            as_query("a", ingest, batch(2, 3), 1)
    assert raw_ids(spark, out) == ["e1"]  # written, not committed
    as_query("b", ingest, batch(1, 2), 0)
    as_query("b", ingest, batch(3, 4), 1)
    assert raw_ids(spark, out) == ["e1", "e2", "e3", "e4"]


def test_a_run_replaced_while_it_works_cannot_commit(spark, as_query):
    out = scratch_path(spark, "ledger")
    rows = spark.createDataFrame([learning(1, "answered")], ENVELOPE)

    def slow(taken, number):
        as_query("b", lambda: ledger.begin(spark, out, 0))
        taken.write.parquet(f"{out}/rows/batch={number}")

    identity = (F.lit("s"), F.col("sequenceNumber"), F.lit(None).cast("timestamp"))
    with pytest.raises(ledger.Fenced):
        as_query("a", ledger.run, rows, out, 0, identity, slow)
    assert ledger.visible(spark, out, spark.read.parquet(f"{out}/rows")).count() == 0


def test_calls_outside_a_query_keep_their_number(spark):
    out = scratch_path(spark, "ledger")
    commit = ledger.begin(spark, out, 7)
    assert commit.number == 7 and not commit.done
    ledger.finish(spark, commit)
    rows = spark.range(3).withColumn("batch", F.lit(7))
    assert ledger.visible(spark, out, rows).count() == 3


def user(number, key, action, name):
    body = {"meta": {"action": f"user_{action}", "entityKey": "USER", "company": "c"},
            "data": {"attributes": {"refId": key, "name": {"firstName": name}}}}
    return record(number, json.dumps(body), float(number))


def test_changes_of_a_new_checkpoint_are_applied(spark, as_query):
    """Batches 0 to 3 merged and compacted; batches 0 and 1 of a new checkpoint then add two keys."""
    out = scratch_path(spark, "ledger")
    database = f"ledger_{out[-8:]}"
    job = jobs.Job("changes", {"gold.dim_user": jobs.ADMIN_CHANGES.targets["gold.dim_user"]}, jobs.ADMIN_CHANGES.route,
                   jobs.ADMIN_CHANGES.admit, jobs.ADMIN_CHANGES.layout, jobs.ADMIN_CHANGES.folders)

    def apply(i, *rows):
        status = jobs.run_change_batch(job, spark.createDataFrame(list(rows), ENVELOPE), i, out, database=database)
        assert all(s == ("ok", None) for s in status.values())

    for i in range(4):
        as_query("a", apply, i, user(i + 1, f"k{i}", "updated", f"n{i}"))
    merge.compact(spark, f"{database}.dim_user")
    old = [user(i + 1, f"k{i}", "updated", f"n{i}") for i in range(4)]
    as_query("b", apply, 0, *old, user(5, "k4", "updated", "n4"))
    as_query("b", apply, 1, user(6, "k5", "updated", "n5"), user(7, "k0", "deleted", ""))
    got = sorted((r.user_id, r.first_name) for r in merge.read(spark, f"{database}.dim_user").collect())
    assert got == [(f"k{i}", f"n{i}") for i in range(1, 6)]
    columns = gold.data_columns("gold.dim_user")
    with pytest.raises(ValueError, match="comes after"):
        last = spark.createDataFrame([], "op string, reset boolean").limit(0)
        merge.merge(spark, f"{database}.dim_user", last, gold.KEYS["gold.dim_user"], columns, 1)


def test_a_second_conversion_reads_new_files_only(spark, tmp_path):
    from learnlake.plans import history
    from test_joins_changes import rows_of

    objects = spark.createDataFrame([(f"s{i}", "choice") for i in range(8)], "id_statement string, interactionType string")
    objects.write.parquet(f"{tmp_path}/objects")
    results = lambda a, b: spark.createDataFrame(
        [("sys", "l", "c", f"s{i}", "r") for i in range(a, b)], "id_sys string, lrs_id string, client_id string, id_statement string, response string"
    )
    run = lambda name: history.follow(
        spark, f"{tmp_path}/in", f"{tmp_path}/objects", f"{tmp_path}/{name}", f"{tmp_path}/out", "follow_test"
    )

    def read(query):
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress if p["batchId"] >= 0)

    results(0, 4).coalesce(1).write.parquet(f"{tmp_path}/in/a+b c")
    assert read(run("x")) >= 4
    results(4, 6).coalesce(1).write.parquet(f"{tmp_path}/in/more")
    before = spark.table("follow_test.dim_lrs_result").count()
    query = run("x")
    query.awaitTermination()
    inputs = [s["numInputRows"] for p in query.recentProgress for s in p["sources"]]
    # a batch reads its files more than once (to note and to convert), never those of the run before
    assert before == 4 and sum(inputs) > 0 and sum(inputs) % 2 == 0 and sum(inputs) < 3 * 4
    assert read(run("x")) == 0
    read(run("y"))  # a new checkpoint sees all three files again
    got = rows_of(spark.table("follow_test.dim_lrs_result"), "statement_id")
    assert got == [(f"s{i}",) for i in range(6)]


def test_an_older_change_after_a_newer_one_changes_nothing(spark):
    """Out of order by batch, with and without the newer one in a compacted base; a deleted key stays deleted."""
    for compacted in (False, True):
        out = scratch_path(spark, "order")
        database = f"order_{out[-8:]}"
        job = jobs.Job("changes", {"gold.dim_user": jobs.ADMIN_CHANGES.targets["gold.dim_user"]}, jobs.ADMIN_CHANGES.route,
                       jobs.ADMIN_CHANGES.admit, jobs.ADMIN_CHANGES.layout, jobs.ADMIN_CHANGES.folders)
        batches = [
            [user(10, "a", "updated", "new"), user(11, "b", "deleted", ""), user(12, "c", "updated", "c1")],
            [user(3, "a", "updated", "old"), user(4, "b", "updated", "old"), user(5, "c", "deleted", "")],
            [user(13, "c", "updated", "c2"), user(10, "a", "updated", "new")],
        ]
        for i, rows in enumerate(batches):
            jobs.run_change_batch(job, spark.createDataFrame(rows, ENVELOPE), i, out, database=database)
            if compacted:
                merge.compact(spark, f"{database}.dim_user")
        got = sorted((r.user_id, r.first_name) for r in merge.read(spark, f"{database}.dim_user").collect())
        assert got == [("a", "new"), ("c", "c2")]


def test_the_state_of_delivered_records_is_bounded(spark, tmp_path):
    """Duplicates go; identities older than the horizon leave the state."""
    hour = 3600.0
    parts = [[record(1, "{}", hour / 2), record(2, "{}", hour)], [record(2, "{}", hour), record(3, "{}", 90 * hour)], [record(4, "{}", 91 * hour)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.deliver_once(jobs.source(spark, f"{tmp_path}/in", spark.createDataFrame([], ENVELOPE).schema, "parquet", 1))
    got = []
    query = jobs.start(stream, lambda df, i: got.extend(r.sequenceNumber for r in df.collect()), f"{tmp_path}/cp")
    query.awaitTermination()
    assert sorted(got) == ["1", "2", "3", "4"]
    kept = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert max(kept) <= 3 and kept[-1] <= 2
