"""Incremental loading: windows, high-water marks, the control table and run summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.sinks.tables import register

# Fixed value: where a table without rows starts.
EPOCH = "2000-01-01 00:00:00"


def window(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows with ``low < column <= high``. Bounds may be values or columns; None leaves a side open."""
    condition = F.lit(True)
    if low is not None:
        condition = condition & (F.col(column) > low)
    if high is not None:
        condition = condition & (F.col(column) <= high)
    return df.where(condition)


def high_water(column: Column) -> Column:
    """Aggregate: the latest value, or the start date when there are no rows."""
    return F.coalesce(F.max(column), F.lit(EPOCH).cast("timestamp_ntz"))


def last_loaded(spark: SparkSession, table: str, column: str = "dt_load", after=None):
    """High-water mark of a target table; the start date when it is missing or empty. Other errors are raised.

    With ``after``, a mark known from elsewhere, only newer rows are looked at and the mark stands if there are none.
    """
    if not spark.catalog.tableExists(table):
        return after or spark.sql(f"SELECT timestamp '{EPOCH}' AS t").first()["t"]
    if after is None:
        return spark.table(table).agg(high_water(F.col(column)).alias("t")).first()["t"]
    return spark.table(table).where(F.col(column) > F.lit(after)).agg(F.max(column).alias("t")).first()["t"] or after


def save_progress(spark: SparkSession, control: str, base: str, tables: list[str] | dict, upto=None) -> None:
    """Append one row per loaded table to the control table kept under ``base``; a dict has a mark for each table."""
    marks = tables if isinstance(tables, dict) else dict.fromkeys(tables, upto)
    saved = [
        F.struct(F.lit(t).alias("table_name"), (m if isinstance(m, Column) else F.lit(m)).cast("timestamp").alias("last_processed"))
        for t, m in marks.items()
    ]
    rows = spark.range(1).select(F.inline(F.array(*saved))).select("*", F.current_timestamp().alias("saved_at"))
    if not spark.catalog.tableExists(control):
        register(spark, control, f"{base}/{control}", rows.schema)
    rows.write.mode("append").insertInto(control)


def progress(spark: SparkSession, control: str) -> DataFrame:
    """Latest saved mark per table."""
    return spark.table(control).groupBy("table_name").agg(F.max("last_processed").alias("last_processed"))


def unprocessed(listing: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Listed inputs that are not recorded as done."""
    return listing.join(done.select(key).distinct(), key, "left_anti")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table as one frame ``(table_name, n)``."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def run_summary(results: DataFrame) -> DataFrame:
    """Per-table results ``(table_name, n, status)`` plus a TOTAL row over tables that loaded."""
    total = results.agg(
        F.lit("TOTAL").alias("table_name"),
        F.sum(F.when(F.col("status") == "ok", F.col("n")).otherwise(0)).alias("n"),
        F.when(F.count_if(F.col("status") != "ok") == 0, "ok").otherwise("failed").alias("status"),
    )
    return results.select("table_name", "n", "status").unionByName(total)
