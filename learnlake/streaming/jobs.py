"""Streaming jobs: the same projections inside ``foreachBatch``.

Each micro-batch is decoded once and kept while its targets are written. A failing target is retried, then parked as
JSON, and never stops the others. Every write is named after the batch's number in the output folder's ledger, so a
repeated batch replaces its own output and a run with a new checkpoint neither overwrites nor repeats what another loaded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from learnlake.functions.ids import sequence_key
from learnlake.functions.keys import normalize_json
from learnlake.functions.paths import at
from learnlake.functions.text import before_colon
from learnlake.operators import changes, joins, routing
from learnlake.operators.shaping import once
from learnlake.parallel import attempt, each
from learnlake.plans import admin, lrs_stream, reading
from learnlake.schemas import gold
from learnlake.session import staged, written
from learnlake.sinks import archive, ledger, merge, tables
from learnlake.sources import envelope

# Source settings.
TRIGGER = "1 second"
FILES_PER_BATCH = 25
OBJECTS_PER_BATCH = 10_000  # small files: a batch costs seconds whatever it holds
MAX_RECORD_AGE_S = 300
REDELIVERY = "24 hours"  # how long the stream keeps a record, and so how long it can be delivered again


@dataclass
class Job:
    """What one event stream does with a decoded micro-batch."""

    name: str
    targets: Mapping[str, Callable[..., DataFrame]]
    route: Callable[[], Column]
    admit: Callable[[], Column] = lambda: F.lit(True)
    layout: Callable[[DataFrame, Column], DataFrame] = archive.learning_layout
    folders: list[str] = field(default_factory=list)


LEARNING = Job(
    "learning", lrs_stream.TARGETS, lambda: routing.stream_route(at("doc", "verbID")),
    layout=archive.learning_layout, folders=["verb", "month", "day", "hour", "lrs_id"],
)
ADMIN_CREATED = Job(
    "admin_created", admin.TARGETS, lambda: routing.entity_route(admin.entity()),
    admit=lambda: routing.is_created_job(admin.action()),
    layout=archive.admin_layout, folders=["month", "day", "hour", "action"],
)
ADMIN_CHANGES = Job(
    "admin_changes", admin.TARGETS, lambda: routing.entity_route(admin.entity()),
    admit=lambda: routing.is_change_job(admin.action()) & routing.has_projected_entity(admin.entity()),
    layout=archive.admin_layout, folders=["month", "day", "hour", "action"],
)
READING = Job(
    "reading", {reading.TABLE: reading.from_stream}, lambda: routing.reading_route(at("doc", "type")),
    layout=archive.reading_layout, folders=["month", "day", "hour", "action"],
)


def source(spark: SparkSession, path: str, schema, fmt: str = "json", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def arrival_time(epoch_seconds: Column) -> Column:
    return F.timestamp_micros((epoch_seconds * 1_000_000).cast("long"))


def split_late(records: DataFrame, arrival: Column, now: Column, max_age_s: int = MAX_RECORD_AGE_S) -> tuple[DataFrame, DataFrame]:
    """``(on time, late)``: a record is late when it arrived more than ``max_age_s`` before ``now``."""
    late = F.coalesce(arrival < now - F.make_dt_interval(secs=F.lit(max_age_s)), F.lit(False))
    return records.where(~late), records.where(late)


def deliver_once(records: DataFrame, horizon: str = REDELIVERY) -> DataFrame:
    """A stream of records without those that were delivered before, in whatever batch, by shard and sequence number.

    The state holds the records that arrived within ``horizon`` of the newest one and is dropped beyond it. Records that
    arrived earlier than that are dropped too, so the horizon must not be shorter than the stream keeps its records.
    """
    keyed = records.withColumns({
        "__arrived": arrival_time(F.col("approximateArrivalTimestamp")), "__shard": before_colon(F.col("eventID")),
    })
    once_each = keyed.withWatermark("__arrived", horizon).dropDuplicatesWithinWatermark(["__shard", "sequenceNumber"])
    return once_each.drop("__arrived", "__shard")


def _write_target(rows: DataFrame, table: str, out: str, batch_id: int, op: str = "insert") -> tuple[str, str | None]:
    return attempt(
        lambda: tables.append(rows, table, f"{out}/tables/{table}", str(batch_id)),
        lambda: archive.write_failed(rows, f"{out}/errors", table, op, str(batch_id)),
    )


def _log_and_archive(job: Job, events: DataFrame, decoded: DataFrame, out: str, batch_id: int) -> None:
    """Raw, processed, unknown and rejected copies plus the ingest log; folders carry the processing time (UTC).

    A failure here fails the batch: what is not archived cannot be replayed.
    """
    now = F.lit(datetime.now(timezone.utc))
    folder = lambda kind: f"{out}/{kind}/batch={batch_id}"
    raw = archive.raw_layout(events, now)
    log = envelope.ingest_log(events, job.name, archive.raw_uri(f"{folder('raw')}/", now))
    known = job.layout(events.where(job.route().isNotNull()), now)
    unknown = archive.plain_layout(events.where(job.route().isNull()))
    rejected = envelope.bad(decoded).drop("doc")
    table = "infrastructure.kinesis_log"
    each({
        "raw": lambda: archive.write_json(raw, folder("raw"), ["month", "day", "hour"], "overwrite", dealt=False),  # one folder a batch
        "log": lambda: tables.append(log, table, f"{out}/tables/{table}", str(batch_id)),
        "processed": lambda: archive.write_json(known, folder("processed"), job.folders, "overwrite"),
        "unknown": lambda: archive.write_json(unknown, folder("unknown"), [], "overwrite"),
        "rejected": lambda: archive.write_failed(rejected, f"{out}/rejected", job.name, "decode", str(batch_id)),
    })


def _identity() -> ledger.Identity:
    return before_colon(F.col("eventID")), F.col("sequenceNumber"), arrival_time(F.col("approximateArrivalTimestamp"))


@contextmanager
def _opened(job: Job, records: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The decoded records and the job's events among them, decoded once and staged while they are used."""
    with staged(envelope.decode(records), "decoded") as decoded:
        yield decoded, envelope.good(decoded).where(job.admit())


def run_batch(job: Job, records: DataFrame, batch_id: int, out: str) -> dict[str, tuple[str, str | None]]:
    """Decode, archive, log and append one micro-batch; returns the status of every target table.

    A batch that has committed before is not run again and returns no status.
    """

    def work(taken: DataFrame, number: int) -> dict[str, tuple[str, str | None]]:
        with _opened(job, taken) as (decoded, events):
            _log_and_archive(job, events, decoded, out, number)
            return each({t: partial(_write_target, build(events), t, out, number) for t, build in job.targets.items()})

    return ledger.run(records, out, batch_id, _identity(), work) or {}


def run_change_batch(
    job: Job,
    records: DataFrame,
    batch_id: int,
    out: str,
    keys: Mapping[str, list[str]] = gold.KEYS,
    database: str = "gold",
) -> dict[str, tuple[str, str | None]]:
    """Decode one micro-batch of updates and deletes and merge it into the catalog tables of ``database``."""
    spark = records.sparkSession

    def write(events: DataFrame, number: int, table: str, build: Callable[..., DataFrame]) -> tuple[str, str | None]:
        rows = build(events, ["op", "arrival", "seq"])
        order = ["arrival", "seq"] + (["item_no"] if "item_no" in rows.columns else [])
        last = changes.latest(rows, keys[table], order)
        name, base, columns = f"{database}.{table.split('.')[1]}", f"{out}/merged", gold.data_columns(table)
        merge.create(spark, name, gold.schema(table), base)
        return attempt(
            lambda: merge.merge(spark, name, last, keys[table], columns, number),
            lambda: archive.write_failed(rows, f"{out}/errors", table, "upsert_delete", str(number)),
        )

    def work(taken: DataFrame, number: int) -> dict[str, tuple[str, str | None]]:
        with _opened(job, taken) as (decoded, events):
            events = events.withColumns(
                {
                    "op": routing.change_kind(admin.action()),
                    "arrival": F.col("approximateArrivalTimestamp"),
                    "seq": sequence_key(F.col("sequenceNumber")),
                }
            )
            _log_and_archive(job, events, decoded, out, number)
            return each({table: partial(write, events, number, table, build) for table, build in job.targets.items()})

    return ledger.run(records, out, batch_id, _identity(), work) or {}


# -- raw tables: ingest, and replay of what came too late ------------------------------------------------------------
def _raw_rows(records: DataFrame, unknown: str | None) -> DataFrame:
    """Readable records as normalized events with the raw table of their verb."""
    good = envelope.good(envelope.decode(records))
    events = once(once(good, text=normalize_json("payload")), event=F.try_parse_json("text"))
    return events.select(routing.raw_table(routing.verb_normalized("event"), unknown).alias("table_name"), "event")


def _with_shard(records: DataFrame) -> DataFrame:
    return records.select("*", before_colon(F.col("eventID")).alias("shard_id"), F.col("sequenceNumber").alias("sequence_number"))


def run_raw_batch(
    records: DataFrame, batch_id: int, out: str, now: Column | None = None, unknown: str | None = routing.CATCH_ALL
) -> None:
    """One micro-batch into the raw tables under ``<out>/raw_tables``.

    Records over the age limit are left out; for each shard one notice names the first and last of them. Readable or
    not, every record that was taken is listed in the ingest log, so a replay can tell it apart. Verbs without a raw table
    go to ``unknown`` (None drops them).
    """

    def work(fresh: DataFrame, number: int) -> None:
        on_time, late = split_late(
            fresh, arrival_time(F.col("approximateArrivalTimestamp")), F.current_timestamp() if now is None else now
        )
        notices = _with_shard(late).groupBy("shard_id").agg(
            F.min_by("sequence_number", sequence_key(F.col("sequence_number"))).alias("start_sequence"),
            F.max_by("sequence_number", sequence_key(F.col("sequence_number"))).alias("end_sequence"),
        )
        numbered = notices.select(F.concat(F.lit(f"{number}-"), F.col("shard_id")).alias("notice_id"), "*")
        taken = _with_shard(on_time).select("shard_id", "sequence_number")
        each({
            "raw": lambda: tables.append_raw(_raw_rows(on_time, unknown), f"{out}/raw_tables", batch=str(number)),
            "taken": lambda: taken.write.mode("overwrite").parquet(f"{out}/taken/batch={number}"),
            "notices": lambda: numbered.write.mode("overwrite").parquet(f"{out}/notices/batch={number}"),
        })

    ledger.run(records, out, batch_id, _identity(), work)


def run_object_batch(docs: DataFrame, batch_id: int, out: str, unknown: str | None = routing.CATCH_ALL) -> None:
    """One micro-batch of object files (see ``files.follow_documents``) into the raw tables under ``<out>/raw_tables``.

    A file holds one event or a list of them. Each file is listed under ``<out>/objects`` with its number of events; a file
    that is not JSON is listed with none and kept under ``<out>/rejected``. A file that changes is a new one; an empty one is
    nothing.
    """

    def work(fresh: DataFrame, number: int) -> None:
        listed = F.try_variant_get("event", "$", "array<variant>")
        read = once(once(fresh, text=normalize_json("payload")), event=F.try_parse_json("text"))
        found = F.when(F.col("event").isNotNull(), F.coalesce(listed, F.array("event")))
        opened = once(read, events=found).persist(StorageLevel.MEMORY_AND_DISK)
        events = opened.select(F.explode("events").alias("event"))
        routed = events.select(routing.raw_table(routing.verb_normalized("event"), unknown).alias("table_name"), "event")
        names = opened.select("path", "modified", F.coalesce(F.size("events"), F.lit(0)).cast("long").alias("events"))
        bad = opened.where(F.col("events").isNull()).select("path", "payload")
        try:
            each({
                "raw": lambda: tables.append_raw(routed, f"{out}/raw_tables", batch=str(number)),
                "objects": lambda: names.write.mode("overwrite").parquet(f"{out}/objects/batch={number}"),
                "rejected": lambda: archive.write_failed(bad, f"{out}/rejected", "objects", "decode", str(number)),
            })
        finally:
            opened.unpersist()

    version = F.concat_ws("@", "path", F.unix_millis("modified"))
    ledger.run(docs, out, batch_id, (F.lit("object"), version, F.col("modified")), work)


def raw_tables(spark: SparkSession, out: str) -> DataFrame:
    """The raw tables' rows of committed batches and of replays."""
    return ledger.visible(spark, out, spark.read.parquet(f"{out}/raw_tables"))


def replay_raw(log: DataFrame, out: str, name: str | None = None, unknown: str | None = routing.CATCH_ALL) -> None:
    """Read the records that the notices name again from the stream's ``log`` and load those not taken before.

    A replay is named after the notices it read, unless it is given a name, and lists what it took: a repeated one replaces
    itself, and one that runs after more notices have come adds to the earlier ones.
    """
    spark = log.sparkSession
    notices, taken = (ledger.visible(spark, out, spark.read.parquet(f"{out}/{x}")) for x in ("notices", "taken"))
    if name is None:
        seen = notices.agg(F.count("*"), F.bit_xor(F.xxhash64("notice_id", "start_sequence", "end_sequence"))).first()
        name = f"replay-{seen[0]}-{(seen[1] or 0) & (2**63 - 1):x}"
    key = ["shard_id", "sequence_number"]
    found = joins.replay(_with_shard(log), notices.drop("batch"))
    before = taken.where(F.col("batch").cast("string") != name).select(*key)
    again = written(found.drop("notice_id").join(before, key, "left_anti").dropDuplicates(key), "replayed")
    again.select(*key).write.mode("overwrite").parquet(f"{out}/taken/batch={name}")
    tables.append_raw(_raw_rows(again, unknown), f"{out}/raw_tables", batch=name)


# -- reading-plan queue ----------------------------------------------------------------------------------------------
def run_queue_batch(messages: DataFrame, batch_id: int, out: str) -> None:
    """One batch of queue messages for ``stream.lql``: rows to append, and the ids that its deletes name.

    Both are kept by batch, so a repeated batch replaces itself; ``queue_table`` puts them together.
    """
    deleting = F.coalesce(F.col("action") == "delete", F.lit(False))
    path = f"{out}/{reading.TABLE}"

    def work(fresh: DataFrame, number: int) -> None:
        rows = reading.from_queue(envelope.good(envelope.from_queue(fresh))).persist(StorageLevel.MEMORY_AND_DISK)
        gone = rows.where(deleting).select("id").distinct()
        try:
            each({
                "rows": lambda: tables.append(rows.where(~deleting), reading.TABLE, f"{path}/rows", str(number)),
                "deletes": lambda: gone.write.mode("overwrite").parquet(f"{path}/deletes/batch={number}"),
            })
        finally:
            rows.unpersist()

    ledger.run(messages, out, batch_id, (F.lit("queue"), F.col("messageId"), F.lit(None).cast("timestamp")), work)


def queue_table(spark: SparkSession, out: str) -> DataFrame:
    """Appended rows that no delete of their own or a later batch names."""
    path = f"{out}/{reading.TABLE}"
    rows, deletes = (ledger.visible(spark, out, spark.read.parquet(f"{path}/{x}")) for x in ("rows", "deletes"))
    last = deletes.where(F.col("id").isNotNull()).groupBy("id").agg(F.max("batch").alias("gone"))
    kept = joins.lookup(rows, last, ["id"]).where(F.col("gone").isNull() | (F.col("batch") > F.col("gone")))
    return kept.select(*gold.COLUMNS[reading.TABLE])


def read_once(handler: Callable[[DataFrame, int], object]) -> Callable[[DataFrame, int], object]:
    """The handler over a batch that is kept while it runs: without that each of its writes would run a stream's state again."""

    def handle(batch: DataFrame, batch_id: int) -> object:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return handler(kept, batch_id)
        finally:
            kept.unpersist()

    return handle


def start(
    records: DataFrame,
    handler: Callable[[DataFrame, int], object],
    checkpoint: str,
    continuous: bool = False,
) -> StreamingQuery:
    """Feed micro-batches to ``handler``; drains what is there now, or keeps running on a short trigger."""
    writer = records.writeStream.foreachBatch(lambda df, batch_id: handler(df, batch_id) and None).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(processingTime=TRIGGER) if continuous else writer.trigger(availableNow=True)
    return writer.start()
