"""Mixing sources to target weights: balanced sampling by the cube method.

Each document of a source is wanted ``target / size of the source`` times. The whole part is taken as copies; the rest
is an inclusion probability. The flight phase moves the probabilities of three documents at a time along the direction
that changes neither their number nor their words, until one of them is 0 or 1. It runs in blocks of bounded size,
each of which leaves undecided at most two documents and a few set aside; those form the blocks of the next level, until
one block a source is left. Its landing phase settles the documents still open so that the words come nearest.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.slots import Slots
from learnlake.session import written

BLOCK = 4096
WORDS = r"[^\x20\x09-\x0D]+"
TIMES = 6  # numbers of copies that are told apart without a join
ASIDE = 12  # documents a block sets aside for the next level, and the last block for the landing phase
EDGE = 1e-9  # a probability this close to 0 or 1 is decided


def words(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def ranked_weights(sources: list[str | None]) -> dict[str | None, float]:
    """1, 2, 3, 1, ... over the sources by code point, NULL last."""
    order = sorted(sources, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    return {s: 1.0 + i % 3 for i, s in enumerate(order)}


def targets(sizes: dict, weights: dict, most: float = 3.0) -> dict:
    """All words shared out by weight; a share stops at ``most`` times its source, what is over is shared out again."""
    goal, left = {s: 0.0 for s in sizes}, float(sum(sizes.values()))
    free = {s for s in sizes if sizes[s] > 0}
    while free:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total > most * sizes[s]}
        if not over:
            for s in free:
                goal[s] = left * weights[s] / total
            break
        for s in over:
            goal[s] = most * sizes[s]
        left -= sum(goal[s] for s in over)
        free -= over
    return goal


def _settled(p: float) -> float:
    return 0.0 if p <= EDGE else 1.0 if p >= 1 - EDGE else p


def flight(p: list[float], size: list[int], draw: Callable[[], float]) -> list[float]:
    """The probabilities after the flight phase; their sum and their words' sum stay, at most two are between 0 and 1."""
    p = list(p)
    active: list[int] = []
    for i in range(len(p)):
        if EDGE < p[i] < 1 - EDGE:
            active.append(i)
        if len(active) == 3:
            active = _step(p, size, active, draw)
    while len(active) > 1:
        after = _step(p, size, active, draw)
        if len(after) == len(active):
            break
        active = after
    return p


def _step(p: list[float], size: list[int], at: list[int], draw: Callable[[], float]) -> list[int]:
    s = [float(size[i]) for i in at]
    if len(at) == 3:
        u = [s[2] - s[1], s[0] - s[2], s[1] - s[0]]
        scale = max(map(abs, u))
        u = [x / scale for x in u] if scale else [1.0, -1.0, 0.0]
    elif s[0] == s[1]:
        u = [1.0, -1.0]
    else:
        return at  # no direction keeps both totals
    up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(at, u) if x)
    down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(at, u) if x)
    step = up if draw() * (up + down) < down else -down
    for i, x in zip(at, u):
        p[i] += step * x
        p[i] = _settled(p[i])
    return [i for i in at if 0 < p[i] < 1]


def land(p: list[float], size: list[int]) -> list[float]:
    """Settle the undecided documents: of all ways the one whose words come nearest, then the one whose number does."""
    left = np.array([i for i, x in enumerate(p) if 0 < x < 1], int)
    if not len(left):
        return list(p)
    chance, weight = np.array(p)[left], np.array(size, float)[left]
    ways = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = np.abs(ways @ weight - chance @ weight)
    count = np.abs(ways.sum(axis=1) - chance.sum())
    p = list(p)
    for i, x in zip(left, ways[np.lexsort((count, off))[0]]):
        p[i] = float(x)
    return p


def _spread(n: int) -> list[int]:
    """Places of the documents set aside, by falling size: at growing distances first, then evenly."""
    places = [(1 << k) - 1 for k in range(ASIDE)] + [k * n // ASIDE for k in range(ASIDE)] + list(range(min(n, ASIDE)))
    return list(dict.fromkeys(k for k in places if k < n))[:ASIDE]


def _fly(seed: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        # the order and the draws depend on the rows only; neighbours are alike in size, those set aside are of all sizes
        block = block.sort_values(["size", "hash", "copy"], ascending=[False, True, True], kind="stable")
        away = np.isin(np.arange(len(block)), _spread(len(block)))
        block, rest = pd.concat([block[~away], block[away]]), block[~away]
        rng = np.random.default_rng([seed, len(block), int(block["hash"].iloc[0]) & 0xFFFFFFFF])
        # what is as good as settled is settled before the flight, so that it can neither be skipped by it nor be left to land
        size, chance = block["size"].tolist(), [_settled(x) for x in block["p"].tolist()]
        p = flight(chance[: len(rest)], size[: len(rest)], rng.random) + chance[len(rest):]
        block["p"] = land(p, size) if last else p
        return block

    return run


def mix(
    docs: DataFrame, weigh: Callable[[list], dict] = ranked_weights, most: float = 3.0, seed: int = 17
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` for every row of ``docs``.

    ``weigh`` maps the list of sources (one entry per source, NULL included) to weights. A NULL text has size 0 and is
    taken as any other. Rows that agree in id, source and size are told apart by ``copy``; each is decided on its own. The
    result depends on the rows alone, not on their order or partitions. An empty table gives no rows. Columns other than
    ``doc_id``, ``source`` and ``text`` are not read.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    counted = written(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    rows = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s"), F.sum("n").alias("n")).collect()
    size, number = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}  # one entry a source
    goal = targets(size, weigh(list(size)), most)
    wanted = {s: goal[s] / size[s] if size[s] else 0.0 for s in size}
    plan = [
        (s, i, size[s], goal[s], int(wanted[s]), wanted[s] - int(wanted[s]), number[s]) for i, s in enumerate(size)
    ]
    sources = spark.createDataFrame(
        plan, "source string, sid int, source_size long, target double, whole int, p double, number long"
    )
    items = (
        counted.alias("c")
        .join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        .select("sid", "doc_id", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"), "p", "number")
        .withColumn("hash", F.xxhash64("doc_id", "size", "copy", F.lit(seed)))
    )
    levels = _levels(max(number.values(), default=0))
    decided = None
    for level in range(levels):
        number_now = F.col("number")
        for _ in range(level):
            number_now = (ASIDE + 2) * F.ceil(number_now / BLOCK)
        block = F.pmod(F.xxhash64("hash", F.lit(level)), F.ceil(number_now / BLOCK)).alias("block")
        flown = items.select("*", block).groupBy("sid", "block").applyInPandas(
            _fly(seed + level, level == levels - 1),
            "sid int, doc_id long, size long, copy long, p double, number long, hash long, block long",
        )
        state = written(flown.drop("block"), "mix-level")
        done = state.where("p = 0 or p = 1")
        decided = done if decided is None else decided.unionByName(done)
        items = state.where("p > 0 and p < 1")
    if decided is None:
        decided = items
    copies = F.col("whole") + F.col("p").cast("int")
    return (
        decided.select("sid", "doc_id", "size", "copy", "p")
        .join(sources.drop("p", "number"), "sid")
        .select("doc_id", "source", "size", "copy", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
    )


def _levels(most: int) -> int:
    """Levels until the largest source is one block."""
    n, levels = most, 1 if most else 0
    while math.ceil(n / BLOCK) > 1:
        n, levels = (ASIDE + 2) * math.ceil(n / BLOCK), levels + 1
    return levels


def apply(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (rows taken 0 times go); columns as they were."""
    decided = written(mix(docs, **options).select("doc_id", "source", "size", "copy", "copies"), "mix-copies")
    times = sorted(r[0] for r in decided.select("copies").distinct().collect())[:TIMES]
    if not times:
        return docs.limit(0)
    # where a slot wants all its rows equally often they are repeated as they are read; texts are shuffled for the others only
    kinds = [F.col("copies") == n for n in times] + [F.col("copies") > times[-1]]
    parted = Slots(decided, ["doc_id", "source"], kinds).mark(docs)
    alike = F.create_map(*[F.lit(x) for i, n in enumerate(times) for x in (1 << i, n)])
    parted = parted.withColumn("_copies", F.try_element_at(alike, F.col("_kinds")))
    alone = parted.select(*docs.columns, F.expr("explode(array_repeat(0, _copies))").alias("_i")).drop("_i")
    marked = parted.where(F.col("_copies").isNull()).select(*docs.columns, words(F.col("text")).alias("_size"))
    again = decided.where("copy > 0").select("doc_id", "source", "size").distinct()

    def same(other: DataFrame) -> Column:
        return (
            F.col("_d.doc_id").eqNullSafe(F.col("_m.doc_id"))
            & F.col("_d.source").eqNullSafe(F.col("_m.source"))
            & (F.col("_d._size") == F.col("_m.size"))
        )

    def repeated(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f"_d.{c}") for c in docs.columns], F.expr("explode(array_repeat(0, _m.copies))").alias("_i")).drop("_i")

    if not again.take(1):
        chosen = decided.where("copies > 0")
        return alone.unionByName(repeated(marked.alias("_d").join(chosen.alias("_m"), same(chosen))))
    # rows that agree in id, source and size are numbered in two steps: within their partition, then over the partitions
    once = decided.where("copies > 0").join(again, _null_safe(decided, again), "left_anti")
    single = repeated(marked.alias("_d").join(once.alias("_m"), same(once)))
    many = marked.alias("_d").join(again.alias("_m"), same(again), "left_semi")
    many = written(many.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "mix-rows")
    group = ["doc_id", "source", "_size"]
    parts = many.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_part")) - F.col("_n")
    parts = parts.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*group, "_part").orderBy("_at"))
    numbered = many.withColumn("_row", inside).join(
        parts,
        F.col("doc_id").eqNullSafe(F.col("_0")) & F.col("source").eqNullSafe(F.col("_1"))
        & (F.col("_size") == F.col("_2")) & (F.col("_part") == F.col("_p")),
    )
    numbered = numbered.withColumn("_copy", F.col("_before") + F.col("_row") - 1)
    chosen = decided.where("copies > 0")
    multiple = repeated(numbered.alias("_d").join(chosen.alias("_m"), same(chosen) & (F.col("_d._copy") == F.col("_m.copy"))))
    return alone.unionByName(single).unionByName(multiple)


def _null_safe(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & a["source"].eqNullSafe(b["source"]) & (a["size"] == b["size"])
