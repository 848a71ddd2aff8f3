"""The list of registered queries: a Spark function and, where SQL can say it, an independent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from learnlake.schemas import gold

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``build(t: Tables) -> DataFrame`` under a name."""

    def wrap(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


def table_sql(table: str, values: dict[str, str], tail: str, extra: dict[str, str] | None = None) -> str:
    """``SELECT`` of a target table's columns: the given expressions, NULL text for the others."""
    columns = [f"{values.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in gold.data_columns(table)]
    columns += [f"{e} AS {c}" for c, e in (extra or {}).items()]
    return f"SELECT {', '.join(columns)} {tail}"
