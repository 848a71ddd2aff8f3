"""Identifier, sentinel and default-value helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Synthetic identifier prefix and the sentinel texts that stand for "no value".
UUID_PREFIX = "00000000-0000-1000-0000-"
NO_ID = "-1"
NO_SCORE = "None"


def padded_uuid(code: Column) -> Column:
    """A UUID-shaped key from a numeric code; more than twelve characters are cut, NULL stays NULL."""
    return F.concat(F.lit(UUID_PREFIX), F.lpad(code.cast("string"), 12, "0"))


def sentinel_to_null(value: Column, sentinel: str = NO_ID) -> Column:
    return F.nullif(value.cast("string"), F.lit(sentinel))


def score(value: Column) -> Column:
    """Score text as a float; the no-score text and anything unreadable become NULL."""
    return F.nullif(value.cast("string"), F.lit(NO_SCORE)).try_cast("float")


def bucket(key: Column, n: int) -> Column:
    """A bucket number in [0, n)."""
    return F.pmod(F.hash(key), F.lit(n))


def sequence_key(number: Column) -> Column:
    """A sequence number of up to 64 digits (there are 56) as text that sorts like the number.

    Any other text is an error: cut or dropped numbers would put changes out of order and lose replays.
    """
    wrong = F.raise_error(F.concat(F.lit("not a sequence number: "), number)).cast("string")
    return F.when(number.isNull() | F.regexp_like(number, F.lit("^[0-9]{1,64}$")), F.lpad(number, 64, "0")).otherwise(wrong)
