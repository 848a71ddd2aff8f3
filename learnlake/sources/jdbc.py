"""Database tables over JDBC. Endpoint and credentials come from the caller's ``options``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def _split(reader, column: str | None, bounds: tuple | None, parts: int):
    """Read in ``parts`` parallel ranges of a numeric or date column."""
    if column is None:
        return reader
    low, high = bounds
    return (
        reader.option("partitionColumn", column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(parts))
    )


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    column: str | None = None,
    bounds: tuple | None = None,
    parts: int = 64,
) -> DataFrame:
    """A whole table; filters and column selection are pushed to the database."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    return _split(reader, column, bounds, parts).load()


def read_query(
    spark: SparkSession,
    options: Mapping[str, str],
    query: str,
    column: str | None = None,
    bounds: tuple | None = None,
    parts: int = 64,
) -> DataFrame:
    """A query the database runs itself (its filter and distinct never leave it)."""
    return read_table(spark, options, f"({query}) AS pushed", column, bounds, parts)


def time_bounds(spark: SparkSession, options: Mapping[str, str], table: str, column: str = "dt_load") -> tuple | None:
    """First and last value of a table's time column, found by the database; None for an empty table."""
    row = read_query(spark, options, f"SELECT min({column}) AS lo, max({column}) AS hi FROM {table}").first()
    return None if row["lo"] is None else (row["lo"], row["hi"])


def append_table(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
