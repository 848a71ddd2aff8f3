import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from learnlake.operators import changes, joins
from learnlake.schemas import gold
from learnlake.session import scratch_path
from learnlake.sinks import merge


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# -- lookups --------------------------------------------------------------------------------------------------------
@pytest.fixture
def small_partitions(spark, no_broadcast):
    """Partitions count as oversized from a few kilobytes on."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_hot_key_is_split_over_tasks(spark, small_partitions, how):
    """Two thirds of the rows share one key, which no task gets whole; the right side is not repeated for the others."""
    key = F.when(F.col("id") % 3 != 0, 7).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 400)
    left = spark.range(0, 60000, 1, 6).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    right = spark.range(300).where("id <> 7" if how == "left_anti" else "true").select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = joins.lookup(left, right, ["k"], how)
    path = scratch_path(spark, "hot")
    joined.withColumn("p", F.spark_partition_id()).write.parquet(path)
    assert spark.read.parquet(path).where("k = 7").select("p").distinct().count() > 3
    assert "Generate" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("k = 7").count() == left.where("k = 7").count()


def test_lookup_refuses_joins_that_cannot_split_the_left_side(spark):
    left, right = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        joins.lookup(left, right, ["k"], "full")


def test_restrict_and_split(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows_of(joins.restrict(df, keys, ["k"]), "v") == [("a",), ("b",)]
    known, new = joins.split_existing(df, keys, ["k"])
    assert rows_of(known, "v") == [("a",), ("b",)] and rows_of(new, "v") == [("c",), ("d",)]


# -- ranges ---------------------------------------------------------------------------------------------------------
def brute_force(points, ranges):
    return sorted((s, p, n) for s, p in points for n, t, lo, hi in ranges if s == t and int(lo) <= int(p) <= int(hi))


def check_ranges(spark, points, ranges):
    log = spark.createDataFrame(points, "shard_id string, sequence_number string")
    notices = spark.createDataFrame(ranges, "notice_id long, shard_id string, start_sequence string, end_sequence string")
    found = joins.replay(log, notices)
    assert rows_of(found, "shard_id", "sequence_number", "notice_id") == sorted(brute_force(points, ranges), key=repr)
    return found


def test_replay_matches_brute_force(spark):
    """Numbers of very different length and spacing, one hot shard, nested, giant, single-record and empty ranges."""
    rng = random.Random(3)
    base = 49 * 10**54
    numbers = [base + rng.randrange(10**rng.randrange(1, 50)) for _ in range(600)] + [5, 10**6]
    points = [(("hot" if rng.random() < 0.5 else f"s{rng.randrange(3)}"), str(n)) for n in numbers]
    ranges = []
    for i in range(60):
        a, b = sorted(int(rng.choice(points)[1]) for _ in range(2))
        ranges.append((i, rng.choice(["hot", "s0", "s1", "none"]), str(a), str(b)))
    ranges += [(100, "hot", "0", str(10**56)), (101, "s0", points[0][1], points[0][1]), (102, "s1", "9", "3")]
    check_ranges(spark, points, ranges)


def test_replay_of_one_record_and_of_nothing(spark):
    check_ranges(spark, [("a", "7"), ("a", "8")], [(1, "a", "7", "7")])
    check_ranges(spark, [("a", "7")], [(1, "a", "9", "3")])
    log = spark.createDataFrame([("a", "7")], "shard_id string, sequence_number string")
    none = spark.createDataFrame([], "notice_id long, shard_id string, start_sequence string, end_sequence string")
    assert joins.replay(log, none).count() == 0


def test_replay_tries_few_pairs(spark):
    """One shard holds everything: the equi-join on bins returns little more than the matches."""
    points = [("hot", str(10**20 + i)) for i in range(20_000)]
    ranges = [(i, "hot", str(10**20 + i * 100), str(10**20 + i * 100 + 24)) for i in range(200)]
    found = check_ranges_plan(spark, points, ranges)
    assert found.count() == 200 * 25
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def check_ranges_plan(spark, points, ranges):
    log = spark.createDataFrame(points, "shard_id string, sequence_number string")
    notices = spark.createDataFrame(ranges, "notice_id long, shard_id string, start_sequence string, end_sequence string")
    return joins.replay(log, notices)


# -- changes --------------------------------------------------------------------------------------------------------
def simulate(target, batch):
    """Apply changes one by one to ``[(key, value, note)]`` rows; the note column is not mapped."""
    rows = [list(r) for r in target]
    for key, value, op in batch:
        if key is None:
            continue
        hits = [r for r in rows if r[0] == key]
        if op == "deleted":
            rows = [r for r in rows if r[0] != key]
        elif hits:
            for r in hits:
                r[1] = value
        else:
            rows.append([key, value, None])
    return sorted((tuple(r) for r in rows), key=repr)


def random_case(rng):
    key = lambda: rng.choice([None, "a", "b", "c", "d", "hot", "hot", "hot"])
    target = [(key(), rng.choice(["1", "2", None]), f"n{i}") for i in range(rng.randrange(0, 9))]
    batch = [(key(), rng.choice(["8", "9", None]), rng.choice(["updated", "updated", "deleted"])) for _ in range(rng.randrange(0, 12))]
    return target, batch


def frames(spark, target, batch):
    t = spark.createDataFrame(target, "k string, v string, note string")
    b = spark.createDataFrame([(i, *r) for i, r in enumerate(batch)], "seq int, k string, v string, op string")
    return t, b


@pytest.mark.parametrize("seed", range(6))
def test_apply_changes_equals_one_by_one(spark, seed):
    target, batch = random_case(random.Random(seed))
    t, b = frames(spark, target, batch)
    got = changes.apply_changes(t, b, ["k"], ["k", "v"], ["seq"])
    assert rows_of(got) == simulate(target, batch)


def test_apply_changes_with_shuffled_joins(spark, no_broadcast):
    target, batch = random_case(random.Random(99))
    t, b = frames(spark, target + [("hot", "1", f"h{i}") for i in range(50)], batch)
    got = changes.apply_changes(t, b, ["k"], ["k", "v"], ["seq"])
    assert rows_of(got) == simulate(target + [("hot", "1", f"h{i}") for i in range(50)], batch)


def test_upsert_and_delete(spark):
    t = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "c", "z"), (None, "d", "w")], "k int, v string, note string")
    rows = spark.createDataFrame([(1, None), (3, "n"), (None, "skip")], "k int, v string")
    assert rows_of(changes.upsert(t, rows, ["k"])) == sorted(
        [(1, None, "x"), (1, None, "y"), (2, "c", "z"), (None, "d", "w"), (3, "n", None)], key=repr
    )
    gone = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    assert rows_of(changes.delete(t, gone, ["k"]), "v") == [("c",), ("d",)]
    assert rows_of(changes.delete_counts(t, gone, ["k"])) == [(1, 2)]


def test_append_then_delete(spark):
    t = spark.createDataFrame([("1", "old"), ("2", "old"), (None, "old")], "id string, note string")
    rows = spark.createDataFrame(
        [("1", "new", None), ("3", "new", "add"), ("4", "new", "add"), ("4", "x", "delete"), ("2", "x", "delete"), (None, "x", "delete")],
        "id string, note string, action string",
    )
    assert rows_of(changes.append_then_delete(t, rows)) == sorted([("1", "old"), ("1", "new"), ("3", "new"), (None, "old")], key=repr)


@pytest.mark.parametrize("every", [2, 100])
def test_merge_publishes_whole_batches(spark, tmp_path, every):
    """Random batches, each applied twice, with and without compaction in between."""
    base, rng, state, table = str(tmp_path / "t"), random.Random(5), [], f"merged_{every}"
    schema = spark.createDataFrame([], "k string, v string, note string, dt_load timestamp").schema
    merge.create(spark, table, schema, base)
    keys, mapped = ["k"], ["k", "v"]
    assert merge.read(spark, table, keys, mapped).count() == 0
    for i in range(5):
        batch = [(k, "1", "updated") for k in ("a", "b", "c", "d", "hot")] if i == 0 else random_case(rng)[1]
        _, b = frames(spark, [], batch)
        last = changes.latest(b, keys, ["seq"])
        for _again in range(2):
            merge.merge(spark, table, last, keys, mapped, i, every)
        state = simulate(state, batch)
        assert rows_of(merge.read(spark, table, keys, mapped), "k", "v", "note") == state
    merge.create(spark, table, schema, base)  # an existing table stays as it is
    assert rows_of(merge.read(spark, table, keys, mapped), "k", "v", "note") == state
    merge.compact(spark, table, keys, mapped)
    assert rows_of(spark.table(table), "k", "v", "note") == state
    # a batch whose files are there but which is not published yet is not seen
    one = changes.latest(frames(spark, [], [("new", "7", "updated")])[1], keys, ["seq"])
    real = spark.sql
    spark.sql = lambda text, *a: 1 / 0 if "SET TBLPROPERTIES" in text else real(text, *a)
    with pytest.raises(ZeroDivisionError):
        merge.merge(spark, table, one, keys, mapped, 9, every)
    del spark.sql
    assert rows_of(merge.read(spark, table, keys, mapped), "k", "v", "note") == state
    merge.merge(spark, table, one, keys, mapped, 9, 100)
    assert merge.read(spark, table, keys, mapped).where("k = 'new'").count() == 1
    known = [r.k for r in merge.read(spark, table, keys, mapped).collect()]
    everything = spark.createDataFrame([(0, k, None, "deleted") for k in known], "seq int, k string, v string, op string")
    merge.merge(spark, table, changes.latest(everything, keys, ["seq"]), keys, mapped, 10, 100)
    assert merge.read(spark, table, keys, mapped).count() == 0


def test_keys_cover_the_tables():
    for table, keys in gold.KEYS.items():
        assert set(keys) <= set(gold.data_columns(table))
