"""File sources: JSON documents, partitioned parquet, and JSON file profiling."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.operators.incremental import unprocessed
from learnlake.sources import jsonscan


def decoded(path: Column) -> Column:
    """The path behind ``_metadata.file_path``, in which a plus sign stands for itself; listings are not encoded."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its decoded path, the text and the parsed document (NULL if it is not JSON)."""
    return _documents(spark.read.text(path, wholetext=True, recursiveFileLookup=True)).drop("modified")


def _documents(texts: DataFrame) -> DataFrame:
    return texts.select(
        decoded(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("value").alias("payload"),
        F.try_parse_json("value").alias("doc"),
    )


def follow_documents(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The files below a folder as a stream of documents, see ``json_documents``, with the time of their last change."""
    reader = spark.readStream.option("wholetext", True).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _documents(reader.text(path))


def history_path(base: str, owner: str, year: str, kind: str = "results") -> str:
    """``<base>/<owner>/<year>/<kind>/``."""
    return f"{base.rstrip('/')}/{owner}/{year}/{kind}/"


def history(spark: SparkSession, base: str, owners: Iterable[str], years: Iterable[str], kind: str) -> DataFrame:
    """All parquet files of the owners and years, with ``owner`` and ``year`` taken from the path."""
    years = list(years)
    paths = [history_path(base, o, y, kind) for o in owners for y in years]
    parts = F.split(F.col("_metadata.file_path"), "/")
    return spark.read.option("recursiveFileLookup", True).parquet(*paths).select(
        "*",
        _before(parts, kind, 2).alias("owner"),
        _before(parts, kind, 1).alias("year"),
    )


def _before(parts: Column, kind: str, steps: int) -> Column:
    """The folder some steps above the last one named ``kind``; the base path may hold that name too."""
    from_end = F.array_position(F.reverse(parts), kind).cast("int")
    return F.when(from_end > 0, F.get(parts, F.size(parts) - from_end - steps))


def follow(spark: SparkSession, path: str, schema=None, archive: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """The parquet files below a folder as a stream, with ``__path``: the checkpoint knows which files were read, so a later
    run opens new files only. With ``archive``, files whose batch is complete are moved there and no longer listed.
    """
    reader = spark.readStream.schema(schema or spark.read.option("recursiveFileLookup", True).parquet(path).schema)
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select("*", decoded(F.col("_metadata.file_path")).alias("__path"))


def load_distinct(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet rows without exact duplicates."""
    return spark.read.parquet(*paths).distinct()


def listing(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Paths and sizes of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
    )


def pending(spark: SparkSession, path: str, done: DataFrame, pattern: str = "*.parquet") -> DataFrame:
    """Files not yet recorded in ``done(path)``."""
    return unprocessed(listing(spark, path, pattern), done)


# -- JSON file profiling --------------------------------------------------------------------------------------------
def profile_json(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """``(path, records)`` per file: a list's length or 1 if the file is one document, else its lines that are documents.

    Files are read line by line, so large ones split over tasks, whatever their lines look like. Each block of a file becomes
    one short row (see ``jsonscan``); these are put together in file order. A file without lines has no row.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    lines = reader.text(path).where(F.trim("value") != "")
    named = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    blocks = named.mapInArrow(jsonscan.summaries, jsonscan.SUMMARY)
    return blocks.groupBy("path").applyInArrow(jsonscan.totals, "path string, records long")


def largest(counts: DataFrame, key: str = "path", count: str = "records") -> DataFrame:
    """The row with the greatest count; the smallest key wins a tie."""
    return counts.orderBy(F.col(count).desc(), F.col(key)).limit(1)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
