"""Fitting rows to a target table, and list handling."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlake.functions.text import truncate_bytes
from learnlake.schemas import gold

# Statement ids that are never loaded.
EXCLUDED_STATEMENTS = ("749b3af7-a667-4a73-9a53-adb605619df0", "e04ef4c3-8368-4d9e-8804-5048fcdbac72")

SPREAD = 200_000  # rows


def conform(
    df: DataFrame, table: str, exclude: Iterable[str] = gold.LOAD_TIME_COLUMNS, extra: Iterable[str] = ()
) -> DataFrame:
    """The table's columns in order: unknown columns dropped, missing ones and ``exclude`` NULL; ``extra`` are kept."""
    skip = set(exclude)
    have = set(df.columns) - skip
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in gold.schema(table).fields
        ],
        *extra,
    )


def stamp(df: DataFrame) -> DataFrame:
    """Fill the load-time columns a table has with the current time."""
    return df.withColumns({c: F.current_timestamp() for c in gold.LOAD_TIME_COLUMNS if c in df.columns})


def reshape(
    df: DataFrame,
    renames: Mapping[str, str],
    schema: T.StructType,
    truncate: Iterable[str] = (),
    excluded: Iterable[str] = EXCLUDED_STATEMENTS,
) -> DataFrame:
    """Select, rename and cast to ``schema``, stamp ``dt_load``, fill gaps with NULL, cut long ids, drop bad statements."""
    source = {new: old for old, new in renames.items() if old in df.columns}
    cut = set(truncate)
    columns = []
    for f in schema.fields:
        if f.name == "dt_load":
            value = F.current_timestamp()
        elif f.name in source:
            value = F.col(f"`{source[f.name]}`").try_cast(f.dataType)
            value = truncate_bytes(value) if f.name in cut else value
        else:
            value = F.lit(None).cast(f.dataType)
        columns.append(value.alias(f.name))
    return valid_statements(df.select(*columns), excluded)


def valid_statements(df: DataFrame, excluded: Iterable[str] = EXCLUDED_STATEMENTS) -> DataFrame:
    """Rows with a statement id that is not on the exclusion list."""
    return df.where(F.col("statement_id").isNotNull() & ~F.col("statement_id").isin(list(excluded)))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later filters must not compute again.

    A filter on a plain computed column is moved below it and repeats its expression, once per mention; a generator's
    output stays where it is. Use it around parsing.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give costly per-row work enough tasks of like size: rows are spread by ``keys``, ``SPREAD`` rows a task at most on average.

    The tasks of a scan do not tell: a file is split by bytes, but its rows come in the few tasks that hold the start of a
    row group. Use it on narrow rows, before the costly columns; the count reads the footers of the files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // SPREAD)), *keys)


def first_item(items: Column) -> Column:
    """First list element, NULL for an empty or missing list."""
    return F.get(items, F.lit(0))


def first_with(items: Column, has: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
    """``value`` of the first list item for which ``has`` holds."""
    return value(F.get(F.filter(items, has), F.lit(0)))
