"""Tables that take updates and deletes: a base version plus a log of changes.

Plain parquet has no row-level merge. A batch only appends its reduced changes, one row per key, under its number, and
then moves the table's head to that number with one catalog statement. A reader takes base and head in one look at the
catalog and applies the changes in between as joins, so it sees whole batches only. ``compact`` writes base and log as a
new base and switches to it with one statement; the log up to there is no longer read. A repeated batch overwrites its
own log folder. Batch numbers rise, also over checkpoints (see ``ledger``); one below the head is an error.

Changes that carry their arrival time and sequence number are ordered by these, not by the batch they came in: beside each
base lies the version of every key it has seen changes of, also of the keys they deleted. A change that is not newer than
its key's version is left out, so an old update or delete that is delivered again later changes nothing.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlake.operators import changes, joins
from learnlake.schemas import gold

HEAD = "merge.head"
LOG_FOLDER = "merge.log"
COMPACT_EVERY = 32  # batches
ORDER = {"arrival": T.DoubleType(), "seq": T.StringType()}  # of a change; both NULL where the caller does not have both, then batches count in their order
_VERSION = re.compile(r"/upto=(-?\d+)-")


def _versions(location: str) -> str:
    """The folder of the key versions that belong to a base."""
    return "/versions/upto=".join(location.rsplit("/upto=", 1))


def _version_schema(keys: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, t) for c, t in (dict.fromkeys(keys, T.StringType()) | ORDER).items()])


def _rank(*more: str) -> Column:
    return F.struct(*ORDER, *more)


def create(spark: SparkSession, table: str, schema: T.StructType, base: str) -> None:
    """An empty table unless it exists."""
    if spark.catalog.tableExists(table):
        return
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    folder = f"{base.rstrip('/')}/{table}"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{folder}/upto=-1-empty")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{folder}/upto=-1-empty' "
        f"TBLPROPERTIES ('{HEAD}' = '-1', '{LOG_FOLDER}' = '{folder}/log')"
    )


def _state(spark: SparkSession, table: str) -> tuple[int, int, str, str]:
    """Batch in the base, last published batch, location of the base, folder of the log: one catalog read."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    properties = dict(re.findall(r"([\w.]+)=([^,\]]*)", rows["Table Properties"]))
    return int(_VERSION.search(rows["Location"])[1]), int(properties[HEAD]), rows["Location"], properties[LOG_FOLDER]


def _pending(spark: SparkSession, keys: list[str], log: str, after: int, head: int, schema: T.StructType, location: str) -> DataFrame:
    """The changes of the batches after ``after`` up to ``head`` that are newer than the base, one row per key."""
    rows = spark.read.schema(schema.add("batch", T.LongType())).parquet(log)
    rows = rows.where((F.col("batch") > after) & (F.col("batch") <= head))
    if after >= 0:
        based = spark.read.schema(_version_schema(keys)).parquet(_versions(location))
        old = based.select(*keys, _rank().alias("__old"))
        newer = F.col("__old").isNull() | F.col("arrival").isNull() | (_rank() > F.col("__old"))
        rows = joins.lookup(rows, old, keys).where(newer).drop("__old")
    last = changes.latest(rows.withColumn("__reset", F.col("reset")).drop("reset"), keys, [*ORDER, "batch"])
    # a key that any of the batches deleted starts anew, also if the batch itself ended with an update
    wiped = rows.groupBy(*keys).agg(F.bool_or("reset").alias("reset"))
    return last.drop("reset", "__reset", "batch").join(wiped, keys)


def _log_schema(schema: T.StructType, keys: list[str], mapped: list[str]) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in dict.fromkeys([*keys, *mapped])]
    marks = [T.StructField("op", T.StringType()), T.StructField("reset", T.BooleanType())]
    return T.StructType([*fields, *marks, *(T.StructField(c, t) for c, t in ORDER.items())])


def read(spark: SparkSession, table: str, keys: list[str] | None = None, mapped: list[str] | None = None) -> DataFrame:
    """The table as of its last published batch. Keys and mapped columns are those of ``gold`` unless given."""
    name = f"gold.{table.split('.')[-1]}"
    keys, mapped = keys or gold.KEYS[name], mapped or gold.data_columns(name)
    after, head, location, log = _state(spark, table)
    current = spark.read.schema(spark.table(table).schema).parquet(location)
    if head <= after:
        return current
    last = _pending(spark, keys, log, after, head, _log_schema(current.schema, keys, mapped), location)
    loaded = {f: F.current_timestamp() for f in gold.LOAD_TIME_COLUMNS}
    return changes.apply_latest(current, last, keys, mapped, defaults=loaded)


def merge(
    spark: SparkSession, table: str, last: DataFrame, keys: list[str], mapped: list[str], batch: int, every: int = COMPACT_EVERY
) -> None:
    """Add one batch of changes, one row per key (see ``changes.latest``), and publish it."""
    after, head, _, log = _state(spark, table)
    if batch < head:
        raise ValueError(f"batch {batch} of {table} comes after batch {head}")
    if batch == head:
        return  # a repeat of the published batch: its files are being read and stay as they are
    fields = _log_schema(spark.table(table).schema, keys, mapped).fields
    ordered = all(c in last.columns for c in ORDER)
    given = {c: F.col(c) if ordered else F.lit(None) for c in ORDER}
    rows = last.select(*[given.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields])
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{log}/batch={batch}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{HEAD}' = '{batch}')")
    if batch - after >= every:
        compact(spark, table, keys, mapped)


def compact(spark: SparkSession, table: str, keys: list[str] | None = None, mapped: list[str] | None = None) -> None:
    """Write base and published log as a new base, then point the table at it."""
    name = f"gold.{table.split('.')[-1]}"
    key = keys or gold.KEYS[name]
    after, head, location, log = _state(spark, table)
    if head <= after:
        return
    folder = f"{location.rsplit('/upto=', 1)[0]}/upto={head}-{uuid.uuid4().hex}"
    seen = spark.read.schema(_version_schema(key).add("batch", T.LongType())).parquet(log)
    seen = seen.where((F.col("batch") > after) & (F.col("batch") <= head)).drop("batch")
    if after >= 0:
        seen = seen.unionByName(spark.read.schema(_version_schema(key)).parquet(_versions(location)))
    newest = seen.where(F.col("arrival").isNotNull()).groupBy(*key).agg(F.max(_rank()).alias("v"))
    newest.select(*key, *[F.col(f"v.{c}").alias(c) for c in ORDER]).write.parquet(_versions(folder))
    read(spark, table, keys, mapped).write.parquet(folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
