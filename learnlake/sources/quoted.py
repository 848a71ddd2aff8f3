"""Records of quoted text files whose values may hold line breaks, without giving a whole file to one task.

Files are read line by line, so a large one splits over tasks at any byte. Whether a line begins inside a value follows
from the quotes before it: one pass counts them for each block of a file, a running sum over the blocks (one row each)
gives the state in which every block begins, and a second pass cuts the blocks into records. What a block holds of records
that cross its border, two pieces at most, is put together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECES = "file string, block long, place int, value string"


def odd_quotes(line: Column, quote: str = '"') -> Column:
    """1 if a line has an odd number of quotes that no backslash escapes, else 0."""
    plain = F.regexp_replace(line, r"\\.", "")
    return ((F.length(plain) - F.length(F.replace(plain, F.lit(quote), F.lit("")))) % 2).cast("int")


def _cut(state: dict[tuple[str, int], int]):
    """Lines of a partition, in order, to records (place NULL) and to what lies at the borders of a block: the end of a record
    that began before (place 0), and the beginning of one that goes on (place 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, lines, begun = None, 0, [], True  # block, state, lines of the open record, whether it began in this block
        out: list[tuple] = []

        def close() -> None:
            if at is not None and lines:
                out.append((*at, 1 if begun else 0, "\n".join(lines)))

        for batch in batches:
            for file, block, value, odd in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != at:
                    close()
                    at, lines = (file, block), []
                    inside = state[at]  # a block that was not there when quotes were counted is an error
                    begun = not inside
                lines.append(value)
                inside ^= odd
                if not inside:
                    out.append((*at, None if begun else 0, "\n".join(lines)))
                    lines, begun = [], True
            yield _table(out)
            out.clear()
        close()
        yield _table(out)

    return run


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["file", "block", "place", "value"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the records of all files below a path, without empty ones; line breaks inside quotes are kept.

    The states that are sent to the tasks are one number for each block of the files (some 128 MB of text each).
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        odd_quotes(F.col("value")).alias("odd"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("n"))
    states = blocks.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2).cast("int").alias("s")).collect()
    cut = lines.mapInArrow(_cut({(r["file"], r["block"]): r["s"] for r in states}), PIECES)
    whole = cut.where("place is null").select("value")
    border = cut.where("place is not null")
    # a record begins at each piece of place 1; the pieces after it belong to it
    order = Window.partitionBy("file").orderBy("block", "place")
    numbered = border.withColumn("record", F.sum(F.when(F.col("place") == 1, 1).otherwise(0)).over(order))
    joined = numbered.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "place", "value"))).alias("p"))
    crossing = joined.select(F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"))
    return whole.unionAll(crossing).where("value <> ''")
