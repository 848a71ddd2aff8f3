"""Reading-plan events ``{type, action, description, info, data: [item, ...]}`` -> ``stream.lql``.

One row per item. Some columns are read from the item itself, others from the first item of the event that has the
key and repeated on all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.paths import at, at_or, present
from learnlake.operators.routing import reading_route
from learnlake.operators.shaping import conform, first_with
from learnlake.schemas import gold

DOC = "doc"
TABLE = "stream.lql"

# Fixed value: the text stored when an event carries no session information.
NO_INFO = "El evento no contiene info"

# Columns and the keys they are read from.
SHARED = (
    "user_id session_id group_id role empresa_id school_level_id school_id started_at finished_at".split()
)
QUEUE_SHARED = SHARED + ["name", "description", "action"]
EVENT_LEVEL = {"type_event": "type", "action_event": "action", "description_event": "description"}
RENAMED = {"ip_address": "ip"}
INFO = {
    "info_user_cookie_session_id": "info.user_cookie_session_id",
    "info_user_id": "info.user_id",
    "info_product_id": "info.product_id",
    "info_school_id": "info.school_id",
    "info_origin": "info.http_flow.origin",
    "info_referrer": "info.http_flow.referrer",
    "info_target": "info.http_flow.target",
}
ITEM_LEVEL = [
    c for c in gold.data_columns(TABLE)
    if c not in SHARED and c not in EVENT_LEVEL and c not in INFO and c not in ("book_teacher_path_id", "book_pack_ids")
]


def _first(items: Column, key: str) -> Column:
    """Value of the first item that has ``key``."""
    return first_with(items, lambda i: present(i, key), lambda i: at(i, key))


def _rows(events: DataFrame, shared: list[str], event_level: dict[str, Column]) -> DataFrame:
    """One row per item with the shared and event-level values beside it."""
    with_items = events.withColumn("items", at(DOC, "data", "array<variant>"))
    once = {f"shared_{key}": _first(F.col("items"), key) for key in shared}
    return with_items.select(
        *[c.alias(n) for n, c in once.items()], *[c.alias(n) for n, c in event_level.items()], F.explode("items").alias("item")
    )


def _teacher_path() -> Column:
    return F.coalesce(at("item", "book_teacher_path_id"), at("item", "book_teacher_id"))


def from_stream(events: DataFrame) -> DataFrame:
    """Stream job: absent item values are empty text, no session information."""
    events = events.where(reading_route(at(DOC, "type")).isNotNull())
    rows = _rows(events, SHARED, {c: at_or(DOC, p, "") for c, p in EVENT_LEVEL.items()})
    columns = {c: at_or("item", RENAMED.get(c, c), "") for c in ITEM_LEVEL}
    columns |= {c: F.col(f"shared_{c}") for c in SHARED} | {c: F.col(c) for c in EVENT_LEVEL}
    columns |= {
        "book_teacher_path_id": F.coalesce(_teacher_path(), F.lit("")),
        "book_pack_ids": at("item", "book_pack_ids"),
    }
    return conform(rows.select(*[v.alias(c) for c, v in columns.items()]), TABLE)


def from_queue(events: DataFrame) -> DataFrame:
    """Queue job: absent values are NULL, missing session information becomes a fixed text."""
    event_level = {c: at(DOC, p) for c, p in EVENT_LEVEL.items()}
    event_level |= {c: at_or(DOC, p, NO_INFO) for c, p in INFO.items()}
    rows = _rows(events, QUEUE_SHARED, event_level)
    columns = {c: at("item", RENAMED.get(c, c)) for c in ITEM_LEVEL if c not in QUEUE_SHARED}
    columns |= {c: F.col(f"shared_{c}") for c in QUEUE_SHARED} | {c: F.col(c) for c in event_level}
    columns |= {"book_teacher_path_id": _teacher_path(), "book_pack_ids": at("item", "book_pack_ids")}
    return conform(rows.select(*[v.alias(c) for c, v in columns.items()]), TABLE)
