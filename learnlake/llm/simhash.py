"""SimHash near-duplicates: fingerprints of word shingles, linked at few differing bits by the generalised pigeonhole.

Fingerprint bits that move together are put into one partition. A dynamic programme gives each partition a threshold so
that thresholds plus one add up to the distance plus one: two fingerprints within the distance then agree with some
partition up to its threshold. Partitions with threshold 0 are probed by their value, those with threshold 1 by their
value without one bit. Candidates from a bucket are verified by the full distance.

Buckets are counted before they are dealt out; a large one is split into blocks and every pair of blocks is compared by
a task of its own, which returns a spanning forest of its links instead of all of them. Components are found with
minimum labels and pointer jumping over tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.llm.frames import annotate, hash_sample
from learnlake.llm.slots import Slots
from learnlake.session import written

SAMPLE = 4000  # distinct fingerprints the partitions are fitted on; any partitions give the same links
ROW = 500  # comparisons that take as long as dealing out one key
BLOCK = 1024  # fingerprints of a bucket compared by one task
SHINGLES = 1 << 16  # hashed at a time
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_SLOT = np.arange(8) * 256


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of all shingles, repeats included; 0 for a text without words."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate([[0], ends[:-1]])
    if len(found) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1:]
    counts = np.zeros(2048, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), SHINGLES):
        pairs = zip(starts[i: i + SHINGLES].tolist(), (ends[i: i + SHINGLES] - 1).tolist())
        h = np.array([digest(joined[a:b], 42) for a, b in pairs], np.uint64)
        counts += np.bincount((h.view(np.uint8).reshape(-1, 8) + _SLOT).ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], words: int = 3, name: str = "fp") -> DataFrame:
    """``keep`` columns and ``name``, the fingerprint as a signed long."""

    def build(_):
        def run(texts: pa.Array) -> dict:
            return {name: np.array([fingerprint(t, words) for t in texts.to_pylist()], np.uint64).view(np.int64)}

        return run

    return annotate(docs, keep, f"{name} long", build)


# ---- partitions and thresholds


class Plan(NamedTuple):
    parts: list[list[int]]  # bit numbers
    thresholds: list[int]  # -1: not probed


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in groups of equal size; each group grows by the bit most correlated with it."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float)
    bits -= bits.mean(axis=0)
    norm = np.sqrt((bits**2).sum(axis=0))
    corr = np.abs(bits.T @ bits) / np.maximum(np.outer(norm, norm), 1e-9)
    free, groups = set(range(64)), []
    for g in range(parts):
        room = 64 // parts + (g < 64 % parts)
        group = [min(free)]
        free -= set(group)
        while len(group) < room:
            rest = sorted(free)
            best = rest[int(corr[np.ix_(group, rest)].sum(axis=0).argmax())]
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _within(sample: np.ndarray, part: list[int], threshold: int) -> float:
    """Share of fingerprint pairs that differ in at most ``threshold`` bits of the part."""
    mask = np.uint64(sum(1 << b for b in part))
    some = sample[:1500] & mask
    n = len(some)
    near = sum(int((np.bitwise_count(some[i + 1:] ^ some[i]) <= threshold).sum()) for i in range(n))
    even = 2.0 ** -len(part) * (1 + len(part) * (threshold > 0))
    return max(near / max(1, n * (n - 1) / 2), even)


def allocate(sample: np.ndarray, count: int, distance: int) -> Plan:
    """The cheapest partitions and thresholds for ``count`` fingerprints: keys dealt out (``ROW`` each) plus candidates expected."""
    best = (float("inf"), None)
    for parts in range((distance + 2) // 2, distance + 2):
        groups = group_bits(sample, parts)
        cost = [
            {-1: 0.0}
            | {t: ROW * count * (1 if t == 0 else len(g)) + _within(sample, g, t) * count * count / 2 for t in (0, 1)}
            for g in groups
        ]
        table = {0: (0.0, [])}  # thresholds plus one spent so far -> cost, thresholds
        for options in cost:
            table = {
                s: min((table[s - t - 1][0] + c, table[s - t - 1][1] + [t]) for t, c in options.items() if s - t - 1 in table)
                for s in range(distance + 2)
                if any(s - t - 1 in table for t in options)
            }
        if distance + 1 in table and table[distance + 1][0] < best[0]:
            best = (table[distance + 1][0], Plan(groups, table[distance + 1][1]))
    return best[1]


def keys(fps: np.ndarray, plan: Plan) -> np.ndarray:
    """The bucket keys of each fingerprint, one row each."""
    out = []
    for i, (part, threshold) in enumerate(zip(plan.parts, plan.thresholds)):
        if threshold < 0:
            continue
        for skip in [None] if threshold == 0 else part:
            value = np.zeros(len(fps), np.uint64)
            for at, bit in enumerate(b for b in part if b != skip):
                value |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(at)
            name = i * 65 + (64 if skip is None else skip)
            out.append(value | np.uint64(name << 40))
    return np.stack(out, axis=1).view(np.int64)


# ---- links


def _forest(fps: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links of one bucket (or of two of its blocks), reduced to one from each member to its smallest."""
    n = len(fps)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    label = np.arange(n)
    while True:
        low = np.where(near, label[None, :], n).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    for i in np.flatnonzero(label != np.arange(n)):
        yield int(fps[i].view(np.int64)), int(fps[label[i]].view(np.int64))


def _linker(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by bucket; a bucket may go on in the next batch."""
        rest, schema = None, pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def links(ids: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(ids)]])
            two = starts[ends - starts == 2]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance]
            a, b = [fps[two + 1].view(np.int64)], [fps[two].view(np.int64)]
            for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
                if pairs := list(_forest(np.unique(fps[s:e]), distance)):
                    x, y = np.array(pairs, np.int64).T
                    a.append(x), b.append(y)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=schema)

        for batch in batches:
            ids = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            fps = batch.column(3).to_numpy().view(np.uint64)
            if rest is not None:
                ids, fps = np.concatenate([rest[0], ids]), np.concatenate([rest[1], fps])
            if not len(ids):
                continue
            last = int(np.argmax((ids == ids[-1]).all(axis=1)))
            if last:
                yield links(ids[:last], fps[:last])
            rest = ids[last:], fps[last:]
        if rest is not None:
            yield links(*rest)

    return run


def links(distinct: DataFrame, plan: Plan, distance: int) -> DataFrame:
    """Links ``a``, ``b`` between fingerprints (column ``fp``, no repeats) that keep all components."""
    arity = sum(1 if t == 0 else len(p) for p, t in zip(plan.parts, plan.thresholds) if t >= 0)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for i in range(0, len(fps), 1 << 14):
                some = fps[i: i + (1 << 14)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys(some.view(np.uint64), plan).ravel()), pa.array(np.repeat(some, arity))], names=["key", "fp"]
                )

    dealt = distinct.select("fp").mapInArrow(deal, "key long, fp long")
    sizes = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    rows = (
        dealt.join(sizes, "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    )
    grouped = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return grouped.mapInArrow(_linker(distance), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``fp``, ``root``: the smallest fingerprint that each linked fingerprint reaches.

    Large-star and small-star rounds: every round points nodes at smaller neighbours and shrinks paths, so the number of
    rounds grows with the logarithm of the longest path. Each round is written to the shared folder.
    """
    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "simhash-edges")
    seen = None
    while True:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        e = written(least.select("a", F.col("m").alias("b")).unionAll(small).distinct(), "simhash-edges")
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return e.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        seen = mark


def cluster(docs: DataFrame, distance: int = 3, words: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` (signed long) and ``component_id`` of every row of ``docs``.

    The component is the smallest ``doc_id`` that can be reached over links; equal fingerprints are linked, also the zero
    of texts without words (NULL, empty, white space). A row with a NULL id belongs to its component and gets its smallest
    non-NULL id, or NULL if there is none. Repeated rows stay. Columns other than ``doc_id`` and ``text`` are not read.
    """
    return _rooted(docs, distance, words).select("doc_id", "fp", "component_id")


def _rooted(docs: DataFrame, distance: int, words: int) -> DataFrame:
    """As ``cluster``, with ``root``, the fingerprint that names the component."""
    marked = written(fingerprints(docs, ["doc_id"], words), "simhash-fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    count = distinct.count()
    sample = np.array([r[0] for r in hash_sample(distinct.select("fp"), SAMPLE, "fp").collect()], np.int64).view(np.uint64)
    plan = allocate(np.sort(sample), count, distance)
    roots = components(links(distinct, plan, distance))
    joined = distinct.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = joined.join(smallest, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, distance: int = 3, words: int = 3) -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id, then the smallest fingerprint, then the
    smallest columns in their order.

    Rows that share an id but belong to different components each stand for their own. Rows with a NULL id stay only where
    nothing else of their component has an id. Columns must have an order (no maps).
    """
    ids = written(_rooted(docs, distance, words), "simhash-components")
    # NULL ids come last; one row a component
    chosen = ids.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("m")).select("m.doc_id", "m.fp")
    chosen = written(chosen, "simhash-chosen")
    several = written(ids.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select("doc_id"), "simhash-ids")
    plain = chosen.join(several, "doc_id", "left_anti").where("doc_id is not null").select("doc_id")
    plain = written(plain, "simhash-plain")
    # rows whose slot holds no other id stay as they are read; texts are shuffled for the others only
    rest = written(ids.join(plain, "doc_id", "left_anti").select("doc_id").distinct(), "simhash-rest")
    parted = Slots(rest, ["doc_id"], [F.lit(True)]).mark(docs)
    others = parted.where("_kinds > 0").select(*docs.columns)
    kept = parted.where("_kinds = 0").select(*docs.columns).unionByName(others.join(plain, "doc_id", "left_semi"))
    if several.isEmpty():
        return kept
    # fingerprints tell apart the rows of an id that has more than one
    again = others.join(several.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    marked = fingerprints(again, docs.columns, words, "_fp").join(
        chosen.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp0")),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_fp") == F.col("_fp0")), "left_semi",
    )
    row = F.min(F.struct(*docs.columns)).alias("row")
    return kept.unionByName(marked.groupBy("doc_id", "_fp").agg(row).select("row.*"))
