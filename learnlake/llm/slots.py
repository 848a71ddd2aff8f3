"""Deciding rows with texts by narrow rows, so that few texts are shuffled.

Keys are hashed to slots. For each kind of narrow row a bitmap says which slots hold one; the bitmaps are bounded and go to
all tasks. A slot that holds one kind only decides its texts where they are read; those of other slots are left to an
exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.session import written

EACH = 16  # slots for each narrow row
MOST = 1 << 26  # slots, 8 MB a bitmap; with more rows than that has room for, more slots hold several kinds
PAGE = 1 << 15  # slots of a bitmap as Spark makes it
CHUNK = 64  # bytes of it that a row looks at


class Slots:
    """Bitmaps over the ``keys`` of ``rows``, one for each of ``kinds`` (boolean columns); keys are compared as text."""

    def __init__(self, rows: DataFrame, keys: list[str], kinds: list[Column]):
        self.keys, self.kinds = keys, len(kinds)
        self.slots = min(MOST, max(PAGE, 1 << (EACH * rows.count()).bit_length()))
        slot = rows.select((self._slot() + 1).alias("_slot"), *[k.alias(f"_kind{i}") for i, k in enumerate(kinds)])
        placed = slot.withColumns({"_page": F.bitmap_bucket_number("_slot") - 1, "_bit": F.bitmap_bit_position("_slot")})
        maps = [F.bitmap_construct_agg(F.when(F.col(f"_kind{i}"), F.col("_bit"))).alias(f"_map{i}") for i in range(len(kinds))]
        chunks = PAGE // 8 // CHUNK
        paged = placed.repartition("_page").groupBy("_page").agg(*maps).select("*", F.expr(f"explode(sequence(0, {chunks - 1})) AS _i"))
        cut = [F.expr(f"substring(_map{i}, _i * {CHUNK} + 1, {CHUNK}) AS _map{i}") for i in range(len(kinds))]
        self.maps = written(paged.select((F.col("_page") * chunks + F.col("_i")).alias("_chunk"), *cut), "slots")

    def mark(self, df: DataFrame) -> DataFrame:
        """``df`` and ``_kinds``: bit i is set if kind i occurs in the slot of the row."""
        slot, wide = self._slot(), CHUNK * 8
        placed = df.select("*", F.floor(slot / wide).alias("_chunk"), (slot % wide).cast("int").alias("_bit"))
        found = placed.join(F.broadcast(self.maps), "_chunk", "left")
        byte = "cast(conv(hex(substring(_map{0}, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
        bits = [f"((shiftright({byte.format(i)}, _bit % 8) & 1) << {i})" for i in range(self.kinds)]
        return found.select(*df.columns, F.expr(f"coalesce({' | '.join(bits)}, 0)").alias("_kinds"))

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.slots))
