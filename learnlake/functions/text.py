"""Text helpers, all native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from learnlake.functions.paths import at, present


# Quote marks removed from text, in this order.
QUOTE_MARKS = ("'", '\\"', '"')


def normal_key(name: Column) -> Column:
    """Lower case without ``_`` and ``-``."""
    return F.lower(F.translate(name, "_-", ""))


def strip_quotes(value: Column) -> Column:
    """Remove single quotes, then escaped double quotes, then plain double quotes."""
    for mark in QUOTE_MARKS:
        value = F.replace(value, F.lit(mark), F.lit(""))
    return value


def last_segment(uri: Column, sep: str = "/") -> Column:
    return F.element_at(F.split(uri, sep), -1)


def before_colon(value: Column) -> Column:
    return F.split_part(value, F.lit(":"), F.lit(1))


def joined_list(doc: Column | str, path: str) -> Column:
    """A list joined with commas; a scalar as it is; an absent path as empty text."""
    return F.when(~present(doc, path), F.lit("")).otherwise(
        F.coalesce(F.array_join(at(doc, path, "array<string>"), ","), at(doc, path))
    )


def chunks(value: Column, size: int) -> Column:
    """The whole text as an array of pieces of at most ``size`` characters; NULL stays NULL."""
    last = F.floor(F.greatest(F.char_length(value) - 1, F.lit(0)) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(value, i * size + 1, F.lit(size)))


def truncate_bytes(value: Column, limit: int = 256) -> Column:
    """The longest prefix of whole characters that fits in ``limit`` UTF-8 bytes.

    A character is at most four bytes, so one of the cuts at limit, limit-1, limit-2, limit-3 ends on a boundary.
    """
    raw = F.encode(value, "UTF-8")
    cuts = [F.try_validate_utf8(F.substring(raw, 1, limit - k).cast("string")) for k in range(4)]
    return F.when(F.octet_length(value) <= limit, value).otherwise(F.coalesce(*cuts))


def full_name(*parts: Column) -> Column:
    """Non-empty parts joined with a space."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), " ")


def full_address(*parts: Column) -> Column:
    """Parts joined with ``", "``, with commas and spaces stripped at both ends (inner gaps stay)."""
    joined = reduce(lambda a, b: F.concat(a, F.lit(", "), b), [F.coalesce(p, F.lit("")) for p in parts])
    return F.btrim(joined, F.lit(", "))


def folder_name(action: Column) -> Column:
    """Lower case with spaces as underscores."""
    return F.replace(F.lower(action), F.lit(" "), F.lit("_"))


def blank_to_null(value: Column) -> Column:
    """Empty or blank text becomes NULL; other text keeps its spaces."""
    return F.when(F.trim(value) != "", value)


def is_image(response: Column) -> Column:
    """The response is an inline image."""
    return F.startswith(response, F.lit("data:image"))
