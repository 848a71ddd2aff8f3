"""Applying updates and deletes to a table as set operations.

A change row has the key columns, the mapped columns, ``op`` (``updated`` or ``deleted``) and an order column. Within
a batch changes count in arrival order. For one key that means: the last change decides; if it is an update, every
existing row of the key takes the mapped values (other columns stay) or one row is added when there is none; a delete
earlier in the batch resets the key to that single added row. Changes with a NULL key part are skipped.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.operators.joins import lookup
from learnlake.session import written

UPDATED, DELETED = "updated", "deleted"


def _has_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def latest(changes: DataFrame, keys: list[str], order: list[str], op: str = "op") -> DataFrame:
    """One row per key: its last change, plus ``reset`` when the key was deleted in this batch.

    The aggregate combines on the map side, so a key with very many changes shuffles one row per task.
    """
    values = [c for c in changes.columns if c not in keys]
    last = changes.where(_has_key(keys)).groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.struct(*order)).alias("__last"),
        F.bool_or(F.col(op) == DELETED).alias("reset"),
    )
    return last.select(*keys, "__last.*", "reset")


def apply_latest(
    target: DataFrame,
    last: DataFrame,
    keys: list[str],
    mapped: list[str],
    op: str = "op",
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Target after the changes in ``last`` (one row per key); added rows take ``defaults`` for unmapped columns."""
    defaults = defaults or {}
    values = [c for c in mapped if c not in keys]
    marks = last.select(
        *keys, *[F.col(c).alias(f"__new_{c}") for c in values], F.lit(True).alias("__hit"), F.col("reset").alias("__reset")
    )
    kept = lookup(target, marks, keys, "left").where(F.col("__hit").isNull() | ~F.col("__reset"))
    updated = kept.select(
        *[
            (F.when(F.col("__hit"), F.col(f"__new_{c}").try_cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c))
            if c in values
            else F.col(c)
            for c in target.columns
        ]
    )
    upserts = last.where(F.col(op) == UPDATED)
    gone = upserts.where(F.col("reset"))
    # only the target keys that changes touch are compared, once each
    existing = lookup(target.select(*keys), upserts.select(*keys), keys, "left_semi").distinct()
    absent = upserts.where(~F.col("reset")).join(existing, keys, "left_anti")
    added = gone.unionByName(absent).select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in mapped or f.name in keys else defaults.get(f.name, F.lit(None)).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return updated.unionByName(added)


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: list[str], mapped: list[str], order: list[str], op: str = "op"
) -> DataFrame:
    """Target after a batch of ordered updates and deletes.

    The last change per key is written once: it is joined several times, and its real size decides how.
    """
    return apply_latest(target, written(latest(changes, keys, order, op), "changes"), keys, mapped, op)


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Update every row of an existing key, add a row for a new one. Without ``order`` keys must be unique in ``rows``."""
    changes = rows.withColumn("op", F.lit(UPDATED))
    if order:
        return apply_changes(target, changes, keys, rows.columns, order)
    return apply_latest(target, changes.where(_has_key(keys)).withColumn("reset", F.lit(False)), keys, rows.columns)


def delete(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the rows whose key occurs in ``rows``."""
    return lookup(target, rows.select(*keys).distinct(), keys, "left_anti")


def delete_counts(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """How many delete requests found their key and how many were skipped (NULL or absent key)."""
    known = target.select(*keys).distinct().withColumn("__hit", F.lit(True))
    return lookup(rows.select(*keys), known, keys).agg(
        F.count_if(F.col("__hit")).alias("deleted"), F.count_if(F.col("__hit").isNull()).alias("skipped")
    )


def append_then_delete(
    target: DataFrame, rows: DataFrame, key: str = "id", action: str = "action", delete_action: str = "delete"
) -> DataFrame:
    """Append the rows whose action is not a delete, then remove the ids the deleting rows name."""
    deleting = F.coalesce(F.col(action) == delete_action, F.lit(False))
    grown = target.unionByName(rows.where(~deleting).select(*target.columns))
    return delete(grown, rows.where(deleting), [key])
