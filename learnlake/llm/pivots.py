"""Vector code compression: one small codebook for each part position, entries found with the help of fixed pivots (LAESA).

Components become integers, vectors are cut into equal parts, and each part is written as the index of its codebook's
nearest entry. The distances from every part to a few fixed pivots are computed once and kept with the row. In each
round the distances between pivots and entries give, by the triangle inequality, a lower bound for every part and
entry: entries are tried in the order of their bounds, and those whose bound is above the best distance so far are never
evaluated. What is evaluated is evaluated in integers, so the result is that of trying all entries.

A round is one pass without a shuffle of the rows: tasks add up their parts by entry and only these sums are merged. Sums
travel as 32-bit limbs, so they are exact for components of any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.vectors import matrix
from learnlake.session import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
PIVOTS = 6  # of each part position; any number gives the same codes
SAFE = 1 << 62  # squared distances below this are computed in 64 bits, others in integers of any size
LIMB = 32

Book = list[np.ndarray]  # for each part position the entries as rows of integers


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exact for every finite double; 64-bit integers where they hold squared distances."""
    top = np.abs(x).max(initial=0.0)
    if top < 2.0**40:
        return np.floor(x * SCALE).astype(np.int64)  # the product with a power of two is exact
    flat = [int(v) * SCALE if abs(v) >= 2.0**53 else int(np.floor(v * SCALE)) for v in x.ravel().tolist()]
    return np.array(flat, object).reshape(x.shape)


def _rows(table: pa.Table, dim: int) -> np.ndarray:
    return integers(matrix(table["embedding"], dim) if dim else np.zeros((len(table), 0)))


def cuts(dim: int) -> list[int]:
    """Where the parts begin and end: equal parts, the first ones longer by one if ``dim`` cannot be divided."""
    return [0, *np.cumsum([len(p) for p in np.array_split(np.arange(dim), PARTS)]).tolist()]


def _paired(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in 64 bits if no squared distance can pass ``SAFE``, else both as integers of any size."""
    top = max((int(abs(a).max()) for a in (x, book) if a.size), default=0)
    if (2 * top) ** 2 * max(1, x.shape[1]) < SAFE:
        return x.astype(np.int64), book.astype(np.int64)
    return x.astype(object), book.astype(object)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to pivots as doubles; not finite where a double cannot hold them."""
    a, b = x.astype(np.float64, copy=False), pivots.astype(np.float64, copy=False)
    with np.errstate(over="ignore", invalid="ignore"):
        return np.stack([np.sqrt(((a - p) ** 2).sum(axis=1)) for p in b], axis=1) if len(b) else np.zeros((len(a), 0))


def choose(book: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Pivots among the first entries: each next one has the greatest sum of distances to those chosen before."""
    if not len(book):
        return book
    picked, total = [0], np.zeros(len(book))
    while len(picked) < min(count, len(book)):
        total += np.nan_to_num(distances(book, book[picked[-1:]])[:, 0], nan=0.0, posinf=1e300)
        total[picked] = -1
        picked.append(int(total.argmax()))
    return book[picked]


def assign(x: np.ndarray, near: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each row (ties to the smaller index), its squared distance, and how many were evaluated.

    ``near`` are the rows' distances to ``pivots``.
    """
    x, book = _paired(x, book)
    n = len(x)
    bound = np.zeros((n, len(book)))
    with np.errstate(over="ignore", invalid="ignore"):
        for p, to_entries in enumerate(distances(pivots, book)):
            mine = near[:, p: p + 1]
            # less than the difference by more than both roundings together; what is not finite bounds nothing
            gap = np.abs(mine - to_entries) - 1e-9 * (mine + to_entries)
            bound = np.maximum(bound, np.where(np.isfinite(gap), gap, 0.0))
    order = np.argsort(bound, axis=1, kind="stable")
    best, at = np.zeros(n, x.dtype), np.full(n, -1)
    reach = np.full(n, np.inf)
    open_, tried = np.arange(n), 0
    for rank in range(len(book)):
        entry = order[open_, rank]
        still = bound[open_, entry] <= reach[open_]
        open_, entry = open_[still], entry[still]
        if not len(open_):
            break
        tried += len(open_)
        d = ((x[open_] - book[entry]) ** 2).sum(axis=1)
        old = at[open_]
        better = (old < 0) | (d < best[open_]) | ((d == best[open_]) & (entry < old))
        rows = open_[better]
        best[rows], at[rows] = d[better], entry[better]
        reach[rows] = np.sqrt(best[rows].astype(np.float64)) * (1 + 1e-9) if best.dtype != object else [_root(v) for v in best[rows]]
    return at, best, tried


def _root(value: int) -> float:
    try:
        return float(value) ** 0.5 * (1 + 1e-9)
    except OverflowError:
        return float("inf")


def digest(book: Book) -> str:
    """SHA-256 of all components as decimal text by part, entry and position, joined with commas."""
    return hashlib.sha256(",".join(str(int(v)) for part in book for entry in part for v in entry).encode()).hexdigest()


def _limbs(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out or [0]


def kept(embeddings: DataFrame, label: str = "label") -> DataFrame:
    """``vec_id``, ``label``, ``embedding`` (doubles) and ``dim`` of the rows whose vector is whole and finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("embedding").isNotNull()).where(F.coalesce(finite, F.lit(False)))
    vector = F.col("embedding").cast("array<double>")
    return rows.select("vec_id", F.col(label).alias("label"), vector.alias("embedding"), F.size("embedding").alias("dim"))


def first_books(rows: DataFrame, entries: int) -> dict[int, Book]:
    """For each number of components the parts of the rows with the smallest ids; equal ids by their components."""
    order = Window.partitionBy("dim").orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
    first = rows.select("dim", "vec_id", "embedding").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= entries)
    books: dict[int, list] = {}
    for r in first.orderBy("dim", "_n").collect():  # a fixed number of rows
        books.setdefault(r["dim"], []).append(r["embedding"])
    out = {}
    for dim, found in books.items():
        x, at = integers(np.array(found, np.float64).reshape(len(found), dim)), cuts(dim)
        out[dim] = [x[:, a:b] for a, b in zip(at, at[1:])]
    return out


def _by_dim(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, pa.Table]]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        dims = batch.column(column).to_numpy()
        for dim in np.unique(dims):
            yield int(dim), table.filter(pa.array(dims == dim)).combine_chunks()


def _measured(rows: DataFrame, pivots: dict[int, Book]) -> DataFrame:
    """The rows with the distances of their parts to the pivots, which all rounds use."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, table in _by_dim(batches, 3):
            x, at = _rows(table, dim), cuts(dim)
            near = np.concatenate([distances(x[:, a:b], p) for a, b, p in zip(at, at[1:], shared.value[dim])], axis=1)
            column = pa.array([row.tobytes() for row in near], pa.binary())
            yield from table.append_column("near", column).to_batches()

    return written(rows.mapInArrow(run, "vec_id long, label string, embedding array<double>, dim int, near binary"), "pivots")


def _assigned(table: pa.Table, dim: int, book: Book, pivots: Book) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    x, at = _rows(table, dim), cuts(dim)
    near = np.frombuffer(b"".join(table["near"].to_pylist()), np.float64).reshape(len(x), -1)
    done = 0
    for k, (a, b) in enumerate(zip(at, at[1:])):
        mine = near[:, done: done + len(pivots[k])]
        done += len(pivots[k])
        index, error, _ = assign(x[:, a:b], mine, book[k], pivots[k])
        yield x[:, a:b], index, error


def _round(rows: DataFrame, books: dict[int, Book], pivots: dict[int, Book]) -> dict[int, Book]:
    """Every entry replaced by the floor of the mean of its parts; an entry without parts stays."""
    shared = rows.sparkSession.sparkContext.broadcast((books, pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_books, all_pivots = shared.value
        sums: dict[tuple[int, int, int], list] = {}
        for dim, table in _by_dim(batches, 3):
            for k, (x, index, _) in enumerate(_assigned(table, dim, all_books[dim], all_pivots[dim])):
                for e in np.unique(index):
                    mine = x[index == e]
                    total = [len(mine), *(int(v) for v in mine.sum(axis=0))]
                    old = sums.get((dim, k, int(e)))
                    sums[dim, k, int(e)] = total if old is None else [p + q for p, q in zip(old, total)]
        out = [
            (dim, k, e, i, limb, v)
            for (dim, k, e), total in sums.items() for i, value in enumerate(total) for limb, v in enumerate(_limbs(value))
        ]
        names = ["dim", "part", "entry", "i", "limb", "v"]
        kinds = [pa.int32()] * 5 + [pa.int64()]
        columns = list(zip(*out)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    parts = rows.mapInArrow(run, "dim int, part int, entry int, i int, limb int, v long")
    merged = parts.groupBy("dim", "part", "entry", "i", "limb").agg(F.sum("v").alias("v")).collect()  # as many as the books hold
    totals: dict[tuple[int, int, int], dict[int, int]] = {}
    for r in merged:
        one = totals.setdefault((r["dim"], r["part"], r["entry"]), {})
        one[r["i"]] = one.get(r["i"], 0) + (r["v"] << (LIMB * r["limb"]))
    out = {dim: [part.astype(object) for part in book] for dim, book in books.items()}
    for (dim, k, e), total in totals.items():
        out[dim][k][e] = [total[i] // total[0] for i in range(1, len(total))]
    return out


def compress(embeddings: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, label: str = "label") -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every row with a whole, finite vector.

    NULL vectors and vectors with a NULL or non-finite component are left out; a vector without components is written as
    eight parts without components. A repeated id has a row for each of its rows; among the first entries rows with equal
    ids come in the order of their components, and NULL ids last. Vectors with different numbers of components have
    codebooks of their own; a number that cannot be divided by eight makes the first parts longer by one. ``error`` and
    ``label_error`` are NULL where they pass 64 bits. An empty table gives no rows; other columns are not read.
    """
    rows = written(kept(embeddings, label).withColumn("label", F.col("label").cast("string")), "pivots-rows")
    books = first_books(rows, entries)
    pivots = {dim: [choose(part) for part in book] for dim, book in books.items()}
    measured = _measured(rows, pivots)
    for _ in range(rounds):
        books = _round(measured, books, pivots)
    shared = rows.sparkSession.sparkContext.broadcast((books, pivots, {dim: digest(book) for dim, book in books.items()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_books, all_pivots, digests = shared.value
        for dim, table in _by_dim(batches, 3):
            found = [(i, e) for _, i, e in _assigned(table, dim, all_books[dim], all_pivots[dim])]
            codes = ["".join(f"{v:02x}" for v in row) for row in np.stack([i for i, _ in found], axis=1).tolist()]
            errors = [sum(row) for row in zip(*(e.tolist() for _, e in found))]
            yield pa.RecordBatch.from_arrays(
                [
                    table["vec_id"].combine_chunks(), table["label"].combine_chunks(), pa.array(codes, pa.string()),
                    pa.array([e if e < 1 << 63 else None for e in errors], pa.int64()),
                    pa.array([digests[dim]] * len(codes), pa.string()),
                ],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"],
            )

    schema = "vec_id long, label string, code string, error long, codebooks_sha256 string"
    coded = written(measured.mapInArrow(run, schema), "pivots-codes")
    whole = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(whole.try_cast("long").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
