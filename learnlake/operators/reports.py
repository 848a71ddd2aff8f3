"""Counts, rates and timing reports over batches and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def success_counts(df: DataFrame, ok: Column, by: list[str]) -> DataFrame:
    """Total, successes, failures and success percentage per group; the aggregate combines before the shuffle."""
    counted = df.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(ok).alias("ok"))
    return counted.withColumns(
        {"failed": F.col("total") - F.col("ok"), "success_rate": F.col("ok") * F.lit(100.0) / F.col("total")}
    )


def target_vs_actual(df: DataFrame, target: Column, actual: Column, ok: Column) -> DataFrame:
    """Messages meant for each shard against successful ones that reached it, with the match percentage."""
    meant = df.groupBy(target.alias("shard")).agg(F.count("*").alias("target"))
    reached = df.where(ok).groupBy(actual.alias("shard")).agg(F.count("*").alias("actual"))
    counts = meant.join(reached, "shard", "full").select(
        "shard",
        F.coalesce("target", F.lit(0)).alias("target"),
        F.coalesce("actual", F.lit(0)).alias("actual"),
    )
    rate = F.when(F.col("target") > 0, F.col("actual") * F.lit(100.0) / F.col("target"))
    return counts.withColumn("match_rate", rate)


def latency(df: DataFrame, millis: Column, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.avg(millis).alias("avg_ms"),
        F.min(millis).alias("min_ms"),
        F.max(millis).alias("max_ms"),
        F.count(millis).alias("samples"),
    )


def throughput(df: DataFrame, seconds: Column, by: list[str] | None = None) -> DataFrame:
    """Rows and rows per second between the first and last time of each group; NULL for a single instant."""
    spans = df.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), (F.max(seconds) - F.min(seconds)).alias("elapsed_s")
    )
    return spans.withColumn("per_second", F.when(F.col("elapsed_s") > 0, F.col("n") / F.col("elapsed_s")))


def greatest_with_flag(df: DataFrame, by: str, value: str, name: str, flag: str) -> DataFrame:
    """Greatest value per group beside a constant true flag."""
    return df.groupBy(by).agg(F.max(value).alias(name), F.lit(True).alias(flag))


def has_rows(df: DataFrame, sample: int = 10) -> int:
    """Number of rows, counted up to ``sample``."""
    return df.limit(sample).count()


def preview(df: DataFrame, order: list[str], n: int = 2) -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(*order).limit(n)
