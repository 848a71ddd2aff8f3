"""Table sinks: appends, guarded replacement, bucketed parquet and the CSV dialect of the bulk loader."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlake.functions.ids import bucket
from learnlake.functions.text import blank_to_null
from learnlake.operators.shaping import conform, stamp
from learnlake.session import written
from learnlake.sources import quoted

BUCKETS = 50


def append_raw(events: DataFrame, path: str, table: str = "table_name", batch: str | None = None) -> None:
    """Append ``(event, dt_load)`` rows to the raw table each event is routed to; NULL routes are dropped.

    Tables are split into load days, which prune an incremental window. Rows keep their ``dt_load`` if they have one. With
    a batch id the rows lie under ``batch=<id>``, and a repeated write replaces itself instead of adding twice.
    """
    when = F.col("dt_load") if "dt_load" in events.columns else F.current_timestamp()
    routed = events.where(F.col(table).isNotNull()).select(table, "event", when.cast("timestamp").alias("dt_load"))
    dated = routed.withColumn("load_date", F.to_date("dt_load"))
    writer = dated.hint("rebalance", table, "load_date").write.partitionBy(table, "load_date")
    if batch is None:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").parquet(f"{path}/batch={batch}")


def append(df: DataFrame, table: str, path: str, batch: str | None = None) -> None:
    """Append rows shaped like ``table``. With a batch id a repeated write replaces itself instead of adding twice."""
    rows = stamp(conform(df, table))
    if batch is None:
        rows.write.mode("append").parquet(path)
    else:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def replace_table(spark: SparkSession, df: DataFrame, table: str, base: str, **properties: str) -> str:
    """Write a new version beside the current one, then point the catalog table at it.

    Readers see the old files until the switch, and ``df`` may read the table it replaces.
    """
    version = f"{base.rstrip('/')}/{table}/{uuid.uuid4().hex}"
    df.write.parquet(version)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    else:
        register(spark, table, version, df.schema)
    for key, value in properties.items():
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")
    spark.catalog.refreshTable(table)
    return version


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == key).collect()
    return rows[0]["value"] if rows else None


def register(
    spark: SparkSession, table: str, location: str, schema: T.StructType, folders: Sequence[str] = ()
) -> None:
    """An external parquet table over a folder; a previous definition is dropped, files are not.

    ``folders`` are whole-number ``name=value`` directory levels; the ones present are added as partitions.
    """
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + [f"{f} int" for f in folders]
    partitioned = f"PARTITIONED BY ({', '.join(folders)})" if folders else ""
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet {partitioned} LOCATION '{location}'")
    if folders:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def replace_if_any(spark: SparkSession, df: DataFrame, table: str, base: str) -> bool:
    """Replace the table only when there is something to load. The result is written once and tested from the files."""
    version = f"{base.rstrip('/')}/{table}/{uuid.uuid4().hex}"
    df.write.parquet(version)
    written = spark.read.schema(df.schema).parquet(version)
    if written.isEmpty():
        return False
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    else:
        register(spark, table, version, df.schema)
    return True


def with_bucket(df: DataFrame, key: str = "statement_id", n: int = BUCKETS) -> DataFrame:
    """Bucket number of each row; non-negative for every key."""
    return df.withColumn("bucket", bucket(F.col(key), n))


def write_bucketed(
    df: DataFrame, path: str, key: str = "statement_id", n: int = BUCKETS, mode: str = "append", dealt: bool = False
) -> None:
    """One dataset split into ``n`` bucket folders in a single pass; big buckets become several files.

    Rows that are ``dealt`` so that a task holds few buckets are written as they lie.
    """
    rows = with_bucket(df, key, n)
    rows = rows if dealt else rows.hint("rebalance", "bucket")
    rows.write.mode(mode).partitionBy("bucket").option("compression", "snappy").parquet(path)


def append_keyed(df: DataFrame, table: str, path: str, key: Sequence[str], n: int = BUCKETS) -> DataFrame:
    """Append to a catalog table whose files lie in ``n`` buckets of the key, and return the table.

    Joins and groupings by the key, or by more columns than the key, read such tables as they lie: tables with equal ``n``
    are not shuffled. A bucket is one task of the reader, so ``n`` is chosen by size (some 1 GB a bucket). An append adds one
    file a bucket. A table that exists keeps its number of buckets; another one is an error.
    """
    if "." in table:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    dealt = df.repartition(n, *key).write.format("parquet").mode("append")
    dealt.bucketBy(n, *key).sortBy(*key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def load_folder(spark: SparkSession, path: str, table: str, schema: T.StructType, base: str, run: str) -> None:
    """Add a folder of bucketed files, ``<base>/run=<run>/bucket=<n>``, to a catalog table.

    The table is created once, over ``base``, with the levels run and bucket; loading a run again only names its
    partitions again, so no row is added twice.
    """
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, run string, bucket int) USING parquet "
        f"PARTITIONED BY (run, bucket) LOCATION '{base}'"
    )
    rows = spark.read.schema(T.StructType([T.StructField("bucket", T.IntegerType())])).parquet(path)  # also of an empty folder
    buckets = [r[0] for r in rows.distinct().collect()]  # the fixed number at most
    specs = " ".join(f"PARTITION (run='{run}', bucket={b}) LOCATION '{path}/bucket={b}'" for b in buckets)
    if specs:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(table)


# -- CSV dialect ----------------------------------------------------------------------------------------------------
# The bulk loader's dialect. A quoted value may hold line breaks.
CSV = {"header": "false", "quote": '"', "escape": "\\", "charToEscapeQuoteEscaping": "\\", "lineSep": "\n"}
MULTILINE = {"multiLine": "true", "mode": "PERMISSIVE"}
REJECTED = "__rejected"


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**CSV).option("quoteAll", "true").option("nullValue", "\\N").mode("overwrite").csv(path)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty and blank text becomes NULL in every text column."""
    return df.select(
        *[
            blank_to_null(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)``: rows with blanks as NULL, and the records (column ``value``) that do not fit the schema.

    A file is cut into records by many tasks (see ``quoted``); the records are parsed once and staged in the shared folder.
    """
    whole = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.fields)
    options = CSV | MULTILINE | {"columnNameOfCorruptRecord": REJECTED, "nullValue": "\\N"}
    parsed = quoted.records(spark, path).select(F.from_csv("value", shape, options).alias("r"))
    staged = written(parsed.select("r.*"), "csv")
    bad = F.col(REJECTED)
    return blanks_to_null(staged.where(bad.isNull()).drop(REJECTED)), staged.where(bad.isNotNull()).select(bad.alias("value"))


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, max_errors: int = 100, park: str | None = None
) -> DataFrame:
    """Rows of a bulk-load folder. Records that do not fit are kept as JSON under ``park`` (beside the folder unless
    given); more than ``max_errors`` of them fail the load."""
    rows, rejected = read_csv(spark, path, schema)
    park = park or f"{path.rstrip('/')}-rejected"
    counted = Observation()
    rejected.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(park)
    if counted.get["n"] > max_errors:
        raise ValueError(f"{counted.get['n']} unreadable records in {path}, kept in {park}")
    return rows
