"""Joins: key restriction, skew-safe lookups, and the replay range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.ids import sequence_key
from learnlake.session import written

RANGE_PIECES = 32
FEW = 100_000  # rows of two ids, some 15 MB: what is still broadcast


def restrict(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``; NULL keys never match and duplicates in ``keys`` add nothing."""
    return df.join(keys.select(*on), on, "left_semi")


def split_existing(df: DataFrame, target: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in the target, and the rest."""
    keys = target.select(*on)
    return df.join(keys, on, "left_semi"), df.join(keys, on, "left_anti")


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a big ``left`` with a smaller ``right``; kinds: inner, left, left_semi, left_anti.

    The planner broadcasts a right side whose measured size allows it. Otherwise both sides are shuffled by the key, and
    an oversized partition of the left side is split over tasks at run time, each with a copy of the right side's few
    rows; the left side of these kinds of join can always be split, so one hot key never fills a task and no side is
    repeated for the others. ``restrict`` and ``split_existing`` rely on the same.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"the left side of a {how} join cannot be split")
    return left.join(right, on, how)


def measured(ids: DataFrame) -> DataFrame:
    """Narrow rows to join with, which may be as many as the others: up to ``FEW`` are broadcast, beyond that both sides are shuffled.

    The planner goes by the size of files, and ids much alike take two bytes there and 150 in memory: it would collect millions
    of them for a broadcast.
    """
    return ids.hint("broadcast" if ids.count() <= FEW else "merge")


def range_match(
    points: DataFrame,
    ranges: DataFrame,
    on: list[str],
    point: str,
    low: str,
    high: str,
    pieces: int = RANGE_PIECES,
) -> DataFrame:
    """Inner join on equal ``on`` columns and ``low <= point <= high`` for non-negative whole numbers up to 18 digits
    longer than the part all bounds share, given as equally long digit strings.

    Ranges are grouped by their length (a power of sixteen); each is cut into at most ``pieces`` + 1 bins of its
    group's width, and a point meets only the ranges of its bin, once per length group present. So a key with very
    many points is spread over bins, the pairs tried stay close to the pairs returned, and nothing is capped.
    """
    # the digits after the common prefix of all bounds, as one number: order is kept, equal texts stay equal
    ranges = written(ranges, "ranges")
    bounds = ranges.agg(F.min(low).alias("lo"), F.max(high).alias("hi")).first()
    if bounds["lo"] is None:
        return points.join(ranges, on, "inner").where(F.lit(False))
    shared = 0
    for a, b in zip(bounds["lo"], bounds["hi"]):
        if a != b:
            break
        shared += 1
    shared = min(shared, len(bounds["lo"]) - 1)
    as_number = lambda c: F.substring(F.col(c), shared + 1, 18).try_cast("long")

    length = F.greatest(as_number(high) - as_number(low), F.lit(1))
    group = F.ceil(F.log2(length) / 4).cast("int")
    width = lambda g: F.greatest(F.floor(F.pow(F.lit(16.0), g) / pieces), F.lit(1)).cast("long")
    cut = (
        ranges.where(F.col(low) <= F.col(high))
        .withColumn("__group", group)
        .withColumn("__width", width(F.col("__group")))
        .withColumn(
            "__bin",
            F.explode(
                F.sequence(
                    F.floor(as_number(low) / F.col("__width")).cast("long"),
                    F.floor(as_number(high) / F.col("__width")).cast("long"),
                )
            ),
        )
        .drop("__width")
    )
    # at most 15 length groups exist
    groups = [r[0] for r in ranges.select(group.alias("g")).distinct().collect() if r[0] is not None]
    inside = points.where(F.col(point).between(F.lit(bounds["lo"]), F.lit(bounds["hi"])))
    spread = inside.withColumn("__group", F.explode(F.array(*[F.lit(g) for g in groups]))).withColumn(
        "__bin", F.floor(as_number(point) / width(F.col("__group"))).cast("long")
    )
    joined = spread.join(cut, [*on, "__group", "__bin"], "inner")
    return joined.where(F.col(point).between(F.col(low), F.col(high))).drop("__group", "__bin")


def replay(log: DataFrame, notices: DataFrame) -> DataFrame:
    """Log records to read again: for each parked-batch notice, all records of its shard from start to end.

    ``log`` has shard_id and sequence_number; ``notices`` has notice_id, shard_id, start_sequence, end_sequence.
    """
    points = log.withColumn("__seq", sequence_key(F.col("sequence_number")))
    ranges = notices.select(
        "notice_id",
        "shard_id",
        sequence_key(F.col("start_sequence")).alias("__start"),
        sequence_key(F.col("end_sequence")).alias("__end"),
    )
    return range_match(points, ranges, ["shard_id"], "__seq", "__start", "__end").drop("__seq", "__start", "__end")
