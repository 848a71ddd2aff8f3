"""JSON archives laid out by time and route.

Every archived record is one JSON row with its payload as text and, where the record has them, its partition key and
sequence number. JSON text escapes line breaks, so a payload over several lines stays one record.

Rows are spread by the folder columns with a rebalance hint: small folders are written by one task, a folder with very
many rows is split over several, whatever its share of the data.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.paths import at
from learnlake.functions.text import folder_name, last_segment
from learnlake.operators.routing import event_type, verb_normalized


def time_parts(when: Column, *names: str) -> dict[str, Column]:
    """``year``, ``month``, ``day``, ``hour`` as zero-padded text in the session time zone (UTC)."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {n: F.date_format(when, patterns[n]) for n in names}


IDENTITY = ("partitionKey", "sequenceNumber")


def raw_uri(prefix: str, when: Column) -> Column:
    """The folder that holds the raw copy of a record: ``<prefix>month=MM/day=DD/hour=HH``.

    The record in it is the one with the log row's partition key and sequence number.
    """
    return F.concat(F.lit(prefix), F.date_format(when, "'month='MM'/day='dd'/hour='HH"))


def _record(events: DataFrame) -> list[str]:
    return [*(c for c in IDENTITY if c in events.columns), "payload"]


def raw_layout(records: DataFrame, when: Column) -> DataFrame:
    """Every decoded record with its month, day and hour folder."""
    return records.select(*_record(records), *_named(time_parts(when, "month", "day", "hour")))


def plain_layout(events: DataFrame) -> DataFrame:
    """Records without folders."""
    return events.select(*_record(events))


def learning_layout(events: DataFrame, when: Column) -> DataFrame:
    """Processed learning events by verb, time and learning-record store."""
    return events.select(
        *_record(events),
        last_segment(F.coalesce(at("doc", "verbID"), F.lit("unknown"))).alias("verb"),
        *_named(time_parts(when, "month", "day", "hour")),
        F.coalesce(at("doc", "lrs_id"), F.lit("unknown")).alias("lrs_id"),
    )


def admin_layout(events: DataFrame, when: Column) -> DataFrame:
    """Processed administration events by time and action."""
    action = F.lower(F.coalesce(at("doc", "meta.action"), F.lit("unknown")))
    return events.select(*_record(events), *_named(time_parts(when, "month", "day", "hour")), action.alias("action"))


def reading_layout(events: DataFrame, when: Column) -> DataFrame:
    """Processed reading-plan events by time, action and type."""
    return events.select(
        *_record(events),
        *_named(time_parts(when, "month", "day", "hour")),
        folder_name(F.coalesce(at("doc", "action"), F.lit("unknown"))).alias("action"),
        F.coalesce(at("doc", "type"), F.lit("unknown_type")).alias("kind"),
    )


def event_type_layout(events: DataFrame, when: Column) -> DataFrame:
    """Normalized events by year, month and event type, with the day."""
    return events.select(
        *_record(events),
        *_named(time_parts(when, "year", "month", "day")),
        event_type(verb_normalized("doc")).alias("event_type"),
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def write_json(df: DataFrame, path: str, folders: list[str], mode: str = "append", dealt: bool = True) -> None:
    """One JSON row per line under ``folder=value`` directories, gzip files; without folders one flat set of files.

    Rows that all go to one folder need not be ``dealt`` by folder: each task writes what it has.
    """
    if not folders:
        df.write.mode(mode).json(path, compression="gzip")
        return
    rows = df.hint("rebalance", *folders) if dealt else df
    rows.write.mode(mode).partitionBy(*folders).json(path, compression="gzip")


def write_failed(df: DataFrame, path: str, table: str, op: str, batch: str) -> None:
    """Rows of a failed write, kept under the operation, the table and the batch."""
    df.write.mode("overwrite").json(f"{path}/{op}_{table.replace('.', '_')}/batch={batch}", compression="gzip")


ODD_IN_FOLDERS = set("\"#%'*/:=?\\\x7f{[]^") | {chr(i) for i in range(1, 32)}
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def write_objects(df: DataFrame, path: str, folder: str, value: str = "value") -> None:
    """One file of text for each row, under ``folder=name``; names are unique.

    Hadoop's local file system starts a process for each file, checksum and folder to set its rights. So in a mounted folder the
    tasks make the files themselves; elsewhere Spark's writer does.
    """
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getScheme() != "file":
        rename = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}  # by the tasks, not the driver, folder by folder
        df.select(folder, value).write.options(**rename).partitionBy(folder).text(path)
        return
    base = urlparse(path).path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                escaped = "".join(f"%{ord(c):02X}" if c in ODD_IN_FOLDERS else c for c in name or NO_NAME)
                os.makedirs(to := os.path.join(base, f"{folder}={escaped}"), exist_ok=True)
                with open(unseen := os.path.join(to, f".{uuid.uuid4().hex}"), "w", encoding="utf-8", newline="") as file:
                    file.write(f"{text.as_py() or ''}\n")
                os.replace(unseen, os.path.join(to, "object.txt"))  # a repeated task replaces its files
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    rows = df.select(F.col(folder).cast("string"), value)
    rows.mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()
