"""Stream envelopes: base64 JSON payloads in flat, nested, queue-wrapped and free-form records.

Every decoder keeps one output row per record with ``payload`` (JSON text), ``doc`` (the parsed VARIANT) and ``error``
(why it could not be read), so a bad record never stops the others; ``good`` and ``bad`` split the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.text import before_colon
from learnlake.operators.shaping import once
from learnlake.schemas.events import QUEUE_MESSAGE

# The marker of records that come from the stream, and the pattern of a data field in any text.
STREAM_SOURCE = "aws:kinesis"
DATA_FIELD = r'"data"\s*:\s*"([A-Za-z0-9+/=]+)"'


def decoded_text(data: Column) -> Column:
    """UTF-8 text of base64 data; NULL if it is not base64 or not UTF-8.

    Characters outside the alphabet are ignored, but only data that is not clean pays for removing them.
    """
    clean = F.try_to_binary(data, F.lit("base64"))
    cleaned = F.try_to_binary(F.regexp_replace(data, "[^A-Za-z0-9+/=]", ""), F.lit("base64"))
    return F.try_validate_utf8(F.coalesce(clean, cleaned).cast("string"))


def json_or_null(text: Column) -> Column:
    """The text itself if it is valid JSON, else NULL."""
    return F.when(F.try_parse_json(text).isNotNull(), text)


def decode(records: DataFrame, data: str = "data") -> DataFrame:
    """Flat records -> the same records with ``payload``, ``doc`` and ``error`` in place of the data column."""
    text = once(records, payload=decoded_text(F.col(data)))
    return (
        once(text, doc=F.try_parse_json("payload"))
        .withColumn(
            "error",
            F.when(F.col(data).isNull(), "no data")
            .when(F.col("payload").isNull(), "not base64 text")
            .when(F.col("doc").isNull(), "not JSON"),
        )
        .drop(data)
    )


def good(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("doc").isNotNull()).drop("error")


def bad(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("error").isNotNull())


def unnest(batches: DataFrame, records: str = "Records") -> DataFrame:
    """``Records[].kinesis`` batches -> flat records."""
    return batches.select(F.explode(records).alias("r")).select(
        "r.eventSource", "r.eventVersion", "r.eventID", "r.eventName", "r.eventSourceARN", "r.awsRegion",
        "r.kinesis.partitionKey", "r.kinesis.kinesisSchemaVersion", "r.kinesis.sequenceNumber", "r.kinesis.data",
        "r.kinesis.approximateArrivalTimestamp",
    )


def from_queue(messages: DataFrame, body: str = "body") -> DataFrame:
    """Queue messages whose JSON body holds the data -> ``messageId, payload, doc, error``."""
    wrapped = messages.select(
        F.coalesce(F.col("messageId"), F.lit("unknown")).alias("messageId"),
        F.from_json(body, "data string").getField("data").alias("data"),
    )
    return decode(wrapped)


def free_form(texts: DataFrame, text: str = "text") -> DataFrame:
    """Any envelope text -> one row per readable payload, other columns repeated.

    Understood forms: a list of records, one record, or an object with ``Records``; records of a list or alone must
    come from the stream. If none of them yields a payload, every ``"data": "<base64>"`` in the text is tried.
    """
    doc = F.try_parse_json(F.trim(F.col(text)))
    entry = "struct<eventSource:string,data:string>"
    from_stream = lambda r: (r["eventSource"] == STREAM_SOURCE) & r["data"].isNotNull()
    listed = F.transform(
        F.filter(F.try_variant_get("doc", "$", f"array<{entry}>"), from_stream), lambda r: r["data"]
    )
    alone = F.when(
        (F.try_variant_get("doc", "$.eventSource", "string") == STREAM_SOURCE), F.try_variant_get("doc", "$.data", "string")
    )
    nested = F.transform(
        F.try_variant_get("doc", "$.Records", "array<struct<kinesis:struct<data:string>>>"),
        lambda r: r["kinesis"]["data"],
    )
    payloads = lambda datas: F.filter(
        F.transform(datas, lambda d: json_or_null(decoded_text(d))), lambda p: p.isNotNull()
    )
    found = once(
        once(texts, doc=doc), payloads=payloads(F.coalesce(listed, F.when(alone.isNotNull(), F.array(alone)), nested))
    )
    anywhere = payloads(F.regexp_extract_all(F.col(text), F.lit(DATA_FIELD), F.lit(1)))
    return (
        found.withColumn("payloads", F.when(F.size("payloads") > 0, F.col("payloads")).otherwise(anywhere))
        .drop("doc")
        .select("*", F.explode("payloads").alias("payload"))
        .drop("payloads")
    )


def ingest_log(records: DataFrame, stream_name: str, uri: Column) -> DataFrame:
    """One log row per record; the shard is the part of the event id before the colon."""
    return records.select(
        F.lit(stream_name).alias("kinesis_name"),
        F.col("eventSource").alias("event_source"),
        F.col("eventVersion").alias("event_version"),
        before_colon(F.col("eventID")).alias("shard_id"),
        F.col("awsRegion").alias("aws_region"),
        F.col("partitionKey").alias("partition_key"),
        F.col("sequenceNumber").alias("sequence_number"),
        uri.alias("s3_uri"),
    )


def queue_messages(texts: DataFrame, text: str = "text") -> DataFrame:
    """``{"Records": [{messageId, body}]}`` texts -> queue messages."""
    message = "struct<" + QUEUE_MESSAGE + ">"
    parsed = F.from_json(text, f"Records array<{message}>")
    return texts.select(F.inline(parsed.getField("Records")))
