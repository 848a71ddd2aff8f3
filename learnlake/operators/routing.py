"""Choosing where an event goes: verb, entity, type and action rules, and the batch filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.paths import at, present
from learnlake.functions.text import last_segment
from learnlake.schemas.events import (
    ENTITIES,
    IGNORED_ENTITIES,
    RAW_TABLE_VERBS,
    READING_TYPES,
    STREAM_VERBS,
    VERB_PREFIX,
)

CATCH_ALL = "lrs_events_all"


# -- verb of an event ---------------------------------------------------------------------------------------------
def _non_empty(verb: Column) -> Column:
    return F.when(verb != "", verb)


def verb_raw_first(doc: str) -> Column:
    """``verbID`` if the event has it, else the statement's verb."""
    return _non_empty(
        F.when(present(doc, "verbID"), at(doc, "verbID")).otherwise(at(doc, "statement.verb.id"))
    )


def verb_normalized(doc: str) -> Column:
    """After key normalization: ``verbid``, else the statement's verb, else the top-level verb.

    The first container that exists decides, even when its verb is empty.
    """
    return _non_empty(
        F.when(present(doc, "verbid"), at(doc, "verbid"))
        .when(_is_object(doc, "statement"), at(doc, "statement.verb.id"))
        .otherwise(at(doc, "verb.id"))
    )


def verb_object_first(doc: str) -> Column:
    """The top-level verb object, else ``verbID``."""
    return F.when(present(doc, "verb.id"), at(doc, "verb.id")).otherwise(at(doc, "verbID"))


def verb_id_only(doc: str) -> Column:
    return at(doc, "verbID")


def _is_object(doc: str, path: str) -> Column:
    return F.schema_of_variant(at(doc, path, "variant")).startswith("OBJECT")


# -- raw table and event type -------------------------------------------------------------------------------------
def raw_table(verb: Column, unknown: str | None = CATCH_ALL) -> Column:
    """The raw table of a verb; other verbs go to ``unknown`` (None drops them). No verb at all gives NULL."""
    known = verb.isin([VERB_PREFIX + v for v in RAW_TABLE_VERBS])
    name = F.concat(F.lit("lrs_events_"), last_segment(verb))
    fallback = F.lit(None).cast("string") if unknown is None else F.when(verb.isNotNull(), F.lit(unknown))
    return F.when(known, name).otherwise(fallback)


def event_type(verb: Column) -> Column:
    """Last part of the verb; ``unknown`` without a slash, ``event`` without a verb."""
    return (
        F.when(verb.isNull() | (verb == ""), "event")
        .when(~F.contains(verb, F.lit("/")), "unknown")
        .otherwise(last_segment(verb))
    )


# -- dispatch: NULL means no projection exists --------------------------------------------------------------------
def stream_route(verb: Column) -> Column:
    return F.when(verb.isin([VERB_PREFIX + v for v in STREAM_VERBS]), last_segment(verb))


def entity_route(entity: Column) -> Column:
    return F.when(entity.isin(list(ENTITIES)), entity)


def reading_route(kind: Column) -> Column:
    return F.when(kind.isin(list(READING_TYPES)), kind)


# -- filters ------------------------------------------------------------------------------------------------------
def change_kind(action: Column) -> Column:
    """``created``, ``updated`` or ``deleted`` found anywhere in the action, in that order; else NULL."""
    lowered = F.lower(action)
    kinds = ("created", "updated", "deleted")
    return F.coalesce(*[F.when(F.contains(lowered, F.lit(k)), F.lit(k)) for k in kinds])


def is_created_job(action: Column) -> Column:
    """The created-events job takes every action that mentions neither an update nor a delete."""
    lowered = F.lower(F.coalesce(action, F.lit("")))
    return ~F.contains(lowered, F.lit("updated")) & ~F.contains(lowered, F.lit("deleted"))


def is_change_job(action: Column) -> Column:
    """The change job takes updates and deletes that do not mention a creation."""
    return F.coalesce(change_kind(action).isin("updated", "deleted"), F.lit(False))


def has_projected_entity(entity: Column) -> Column:
    """The entity is named and not on the ignore list."""
    return F.coalesce((entity != "") & ~entity.isin(list(IGNORED_ENTITIES)), F.lit(False))


def replayable(dlq: DataFrame) -> DataFrame:
    """Parked-batch notices that expired by age and name their full range."""
    info = F.col("KinesisBatchInfo")
    fields = ("shardId", "startSequenceNumber", "endSequenceNumber", "streamArn")
    complete = F.lit(True)
    for name in fields:
        complete = complete & info.getField(name).isNotNull()
    return dlq.where((F.col("requestContext.condition") == "RecordAgeExceeded") & complete)


def route_counts(routed: DataFrame, route: str = "route") -> DataFrame:
    """Rows per route; events without one are counted as ``unknown``."""
    return routed.groupBy(F.coalesce(F.col(route), F.lit("unknown")).alias(route)).agg(F.count("*").alias("n"))
