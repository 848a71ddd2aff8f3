"""Approximate nearest neighbours over randomly rotated one-bit codes.

Every vector is taken relative to the mean of all, rotated by one random orthogonal matrix and kept as the signs of its
components, packed into bits, with two correction scalars: its length and the inner product of the unit vector with its
code. An unbiased estimate of a query's inner product and a bound of its error, that of rounding included, follow from the
bits. A vector is reranked by its true distance when its lower bound is not above the ``top``-th smallest upper bound. All
this is done in units of the largest component, so that it holds for components of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.llm import vectors
from learnlake.session import written

CONFIDENCE = 3.0  # standard deviations within which an estimate is taken to lie
STEP = 128  # queries compared at a time
ROUNDING = 1e-13  # of estimates, as a share of the squared lengths
PLAIN = 2.0**400  # between this and its inverse squared distances are computed as they are, else in units


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def encode(x: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length and code correction of each vector."""
    y = (x - mean) @ rotation(x.shape[1])
    norm = np.sqrt((y**2).sum(axis=1))
    unit = y / np.where(norm > 0, norm, 1)[:, None]
    bits = unit > 0
    aligned = np.abs(unit).sum(axis=1) / np.sqrt(x.shape[1])
    return np.packbits(bits, axis=1), norm, np.where(norm > 0, aligned, 1.0)


def index(embeddings: DataFrame) -> tuple[DataFrame, dict[int, tuple[float, list[float]]]]:
    """``_row``, ``vec_id``, ``embedding``, ``code``, ``norm``, ``aligned`` of every usable row; the unit and the mean by dimension.

    Rows with a NULL id, and vectors that are NULL, empty, zero or hold a NULL or non-finite component, are left out.
    """
    some = F.exists("embedding", lambda x: x != 0)
    rows = embeddings.where(F.col("vec_id").isNotNull() & vectors.usable(F.col("embedding"))).where(some)
    rows = written(
        rows.select(F.monotonically_increasing_id().alias("_row"), "vec_id", F.col("embedding").cast("array<double>").alias("embedding")),
        "onebit-rows",
    )
    # one row a dimension count; a mean is as long as one vector
    largest = F.max(F.array_max(F.transform("embedding", F.abs))).alias("m")
    units = {r["d"]: 2.0 ** (math.frexp(r["m"])[1] - 1) for r in rows.groupBy(F.size("embedding").alias("d")).agg(largest).collect()}
    known = F.create_map(*[F.lit(v) for pair in units.items() for v in pair]) if units else F.lit(None).cast("map<int,double>")
    parts = rows.select(F.size("embedding").alias("d"), F.posexplode("embedding").alias("i", "x"))
    sums = parts.groupBy("d", "i").agg(F.avg(F.col("x") / known[F.col("d")]).alias("m"))
    listed = sums.groupBy("d").agg(F.collect_list(F.struct("i", "m"))).collect()
    means = {r[0]: (units[r[0]], [x[1] for x in sorted(r[1])]) for r in listed}
    shared = rows.sparkSession.sparkContext.broadcast(means)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            size = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(size):
                part = table.filter(pa.array(size == dim))
                unit, mean = shared.value[int(dim)]
                code, norm, aligned = encode(vectors.matrix(part["embedding"], int(dim)) / unit, np.array(mean))
                for name, values in (
                    ("code", pa.array([c.tobytes() for c in code], pa.binary())), ("norm", pa.array(norm)),
                    ("aligned", pa.array(aligned)),
                ):
                    part = part.append_column(name, values)
                yield from part.combine_chunks().to_batches()

    schema = "_row long, vec_id long, embedding array<double>, code binary, norm double, aligned double"
    return written(rows.mapInArrow(run, schema), "onebit-index"), means


def distances(x: np.ndarray, q: np.ndarray, unit: float) -> np.ndarray:
    if 1 / PLAIN < unit < PLAIN:
        return np.sqrt(((x - q) ** 2).sum(axis=1))
    return np.sqrt(((x / unit - q / unit) ** 2).sum(axis=1)) * unit


def _cell(top: int, means: dict):
    def run(block: pa.Table, asking: pa.Table, dim: int) -> dict:
        x, q = vectors.matrix(block["embedding"], dim), vectors.matrix(asking["embedding"], dim)
        ids, own = block["vec_id"].to_numpy(), asking["vec_id"].to_numpy()
        norm, aligned = block["norm"].to_numpy(), block["aligned"].to_numpy()
        packed = np.frombuffer(b"".join(block["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
        signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float64) * 2 - 1
        spread = CONFIDENCE * np.sqrt(np.maximum(0, 1 - aligned**2)) / aligned / np.sqrt(max(1, dim - 1))
        unit, mean = means[dim]
        turned = (q / unit - np.array(mean)) @ rotation(dim)
        length = np.sqrt((turned**2).sum(axis=1))
        out = {"query_id": [], "vec_id": [], "score": []}
        for a in range(0, len(q), STEP):
            some, ln = turned[a: a + STEP], length[a: a + STEP, None]
            inner = (some @ signs.T) / np.sqrt(dim) / aligned  # estimate of <query, unit vector>
            error = 2 * norm * ln * spread + ROUNDING * (norm + ln) ** 2
            guess = norm**2 + ln**2 - 2 * norm * inner
            others = own[a: a + STEP, None] != ids
            guess[~others] = np.inf
            upper = guess + error
            edge = np.partition(upper, top - 1, axis=1)[:, top - 1] if len(ids) > top else np.full(len(some), np.inf)
            for k, near in enumerate((guess - error <= edge[:, None]) & others):
                at = np.flatnonzero(near)
                score = distances(x[at], q[a + k], unit)
                best = np.lexsort((ids[at], score))[:top]
                out["query_id"] += [own[a + k]] * len(best)
                out["vec_id"] += ids[at[best]].tolist()
                out["score"] += score[best].tolist()
        return out

    return run


def nearest(embeddings: DataFrame, asks: int, top: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``top`` nearest of each row whose id is divisible by ``asks``.

    The score is the Euclidean distance of the original vectors in doubles; ties go to the smaller id. A repeated id asks
    once, by the smallest of its vectors, and each of its rows is a candidate of others; rows with the query's own id are not its candidates. Unusable rows
    (see ``index``) take no part; an empty table gives no rows; a query with fewer candidates gets them all.
    """
    rows, means = index(embeddings)
    asking = F.min(F.struct("embedding", "code", "norm", "aligned")).alias("q")
    queries = rows.where(F.col("vec_id") % asks == 0).groupBy("vec_id").agg(asking).select("vec_id", "q.*")
    return vectors.search(rows, queries, ["code", "norm", "aligned"], _cell(top, means), "double", top, F.col("score"))
