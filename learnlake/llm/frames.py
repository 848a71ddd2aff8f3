"""Helpers shared by the corpus operators: tables, folds, bounded samples, Arrow batches over one text column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# what the documents table carries from stage to stage
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
BATCH = "5m"  # bytes of an Arrow batch between the stages of the pipeline


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: Column, n: int) -> Column:
    """``crc32(key as text) mod n``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % n


def hash_sample(df: DataFrame, rows: int, key: str) -> DataFrame:
    """The rows with the ``rows`` smallest hashes of ``key``; only the hashes are sorted, not the rows.

    Rows that share a key stay together; ``dropDuplicates`` on it bounds what is collected.
    """
    h = F.xxhash64(key)
    cut = df.select(h.alias("h")).distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.where(F.lit(False) if cut is None else h <= cut)


def annotate(
    df: DataFrame, keep: list[str], out: str, build: Callable[[object], Callable[[pa.Array], dict]], model: object = None
) -> DataFrame:
    """``keep`` columns plus the columns of ``out`` (a DDL string) that ``build(model)(texts)`` returns for each batch.

    ``model`` is sent once to each executor. Columns of ``df`` other than ``keep`` and ``text`` are not read.
    """
    source = df.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType([*df.select(*keep).schema.fields, *T.StructType.fromDDL(out).fields])
    names = [f.name for f in schema.fields]
    shared = _shared(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = build(shared.value)
        for batch in returning(batches):
            made = score(batch.column(len(keep)))
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [x if isinstance(x, pa.Array) else pa.array(x) for x in (made[n] for n in names[len(keep):])]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)


def keep_where(df: DataFrame, build: Callable[[object], Callable[[pa.Array], np.ndarray]], model: object = None) -> DataFrame:
    """The rows whose text passes ``build(model)(texts)``, with all their columns; no shuffle and no join back."""
    shared, at = _shared(df.sparkSession, model), df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = build(shared.value)
        for batch in returning(batches):
            yield batch.filter(pa.array(passes(batch.column(at)), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at ``BATCH`` bytes, not only at their number of rows: the JVM and the worker hold a few at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def returning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; Arrow's free memory goes back to the system before the first, between two and after the last of them.

    Otherwise a Python worker that waits for its next task holds what the largest batch of earlier stages took.
    """
    pa.default_memory_pool().release_unused()
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def _shared(spark: SparkSession, model: object) -> Broadcast:
    return spark.sparkContext.broadcast(model)
