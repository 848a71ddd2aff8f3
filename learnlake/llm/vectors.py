"""Vectors searched block by block: a stated set of queries against all rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS = 1 << 16  # rows of a block, at most about
QUERIES = 1 << 13  # queries of a block, at most about
FOUND = "query_id long, vec_id long, score {}"


def usable(vector: Column) -> Column:
    """Not NULL, not empty, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column as a row matrix of doubles."""
    if not len(column):
        return np.zeros((0, dim))
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search(
    rows: DataFrame, queries: DataFrame, columns: list[str], cell: Callable[[pa.Table, pa.Table, int], dict],
    score: str, top: int, best: Column,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``top`` of each query over all rows.

    ``rows`` and ``queries`` have ``vec_id``, ``embedding`` and ``columns``; ``rows`` also ``_row``, a number of its own for
    each row. Both are dealt out to the cells of a grid of blocks, so no task holds more than one block of each; ``cell``
    gives the best of its block for each query as arrays (query_id, vec_id, score), and these few are merged. Only vectors
    with equally many components meet.
    """
    spark = rows.sparkSession
    n, asked = rows.count(), queries.count()
    across = max(-(-n // ROWS), min(spark.sparkContext.defaultParallelism, -(-n // 512)), 1)
    down = max(-(-asked // QUERIES), 1)
    key, other = ["_dim", "_r", "_q"], F.size("embedding").alias("_dim")
    left = rows.select(
        other, F.pmod(F.xxhash64("_row"), F.lit(across)).cast("int").alias("_r"),
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("_q"), "vec_id", "embedding", *columns,
    )
    right = queries.select(
        other, F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("_r"),
        F.pmod(F.xxhash64("vec_id"), F.lit(down)).cast("int").alias("_q"), "vec_id", "embedding", *columns,
    )
    schema = FOUND.format(score)
    kind = {"double": pa.float64(), "long": pa.int64()}[score]

    def run(keys: tuple, block: pa.Table, asking: pa.Table) -> pa.Table:
        made = {"query_id": [], "vec_id": [], "score": []}
        if len(block) and len(asking):
            made = cell(block, asking, keys[0].as_py())
        return pa.table({k: pa.array(made[k], kind if k == "score" else pa.int64()) for k in ("query_id", "vec_id", "score")})

    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(best, "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
