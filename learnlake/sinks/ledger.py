"""What a job has committed, across checkpoints.

A streaming query's batches are numbered from 0 again when it starts with a new checkpoint, and its source is read from
the start. So sinks are not named after the bare batch number. Every query id (one per checkpoint) gets an epoch under the
job's output folder, and a batch writes under ``epoch * 2**40 + batch``, a number that rises over all epochs. A new epoch
seals the older ones: it notes how far each had committed. From then on an older run that is still alive is refused, and
what it had written beyond that mark stays invisible (``visible``).

The identities of the records that were taken are kept by epoch and arrival day. A later epoch leaves out those that a
sealed epoch has committed (``fresh``), reading only the days its batch holds; so a record read again under a new checkpoint
is neither loaded twice nor lost. Epochs and marks are a few small files; a file is created only if it is not there yet,
which the folder's file system has to do in one step.

Calls outside a streaming query have no epoch: they are named after the number they are given, as often as they like.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import TypeVar

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.operators import joins

Result = TypeVar("Result")
Identity = tuple[Column, Column, Column]  # shard, sequence number, arrival time of a record
QUERY_ID = "sql.streaming.queryId"  # the local property that Spark sets for the thread of a streaming query
EPOCH = 1 << 40  # batches of one epoch
IDS = ["shard_id", "sequence_number"]
TAKEN = "epoch int, day date, number long, shard_id string, sequence_number string"


class Fenced(RuntimeError):
    """A newer run has taken over the output folder."""


@dataclass
class Commit:
    """One micro-batch of one run."""

    out: str
    batch: int
    epoch: int | None = None  # None: not called by a streaming query
    sealed: dict[int, int] | None = None  # older epochs and their last committed batch
    done: bool = False  # an earlier try of this batch has committed

    @property
    def number(self) -> int:
        return self.batch if self.epoch is None else self.epoch * EPOCH + self.batch


class _Folder:
    """Small files of a shared folder, through the file system Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.fs = self._at("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str = "") -> list[str]:
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at) if s.isFile()) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Whether the file was not there and now is."""
        at = self._at(name)
        if not self.fs.createNewFile(at):
            return False
        stream = self.fs.create(at, True)
        stream.write(text.encode())
        stream.close()
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), False)


def _epochs(folder: _Folder) -> dict[int, dict]:
    """Every epoch with what its file says; one whose file was never filled is left out."""
    found = {int(n): folder.read(f"epochs/{n}") for n in folder.names("epochs")}
    return {n: json.loads(text) for n, text in found.items() if text}


def _last(folder: _Folder, epoch: int) -> int:
    """The last committed batch of an epoch; -1 if there is none."""
    return max((int(n) for n in folder.names(f"done/{epoch}")), default=-1)


def _state(folder: _Folder) -> tuple[dict[int, dict], dict[int, int]]:
    """Epochs, and the last visible batch of each: what the newest epoch sealed, and its own mark."""
    epochs = _epochs(folder)
    if not epochs:
        return {}, {}
    newest = max(epochs)
    return epochs, {int(n): b for n, b in epochs[newest]["sealed"].items()} | {newest: _last(folder, newest)}


def begin(spark: SparkSession, out: str, batch: int) -> Commit:
    """The commit of a batch; the first batch of a query with a new id opens an epoch and seals the others."""
    query = spark.sparkContext.getLocalProperty(QUERY_ID)
    if query is None:
        return Commit(out, batch)
    folder = _Folder(spark, f"{out}/_ledger")
    while True:
        epochs, last = _state(folder)
        own = next((n for n, e in epochs.items() if e["query"] == query), None)
        if own is not None:
            break
        number = max((int(n) for n in folder.names("epochs")), default=-1) + 1
        folder.create(f"epochs/{number}", json.dumps({"query": query, "sealed": last}))
    if own < max(epochs):
        raise Fenced(f"query {query} (epoch {own}) has been replaced by epoch {max(epochs)} of {out}")
    sealed = {n: b for n, b in last.items() if n != own}
    return Commit(out, batch, own, sealed, batch <= last[own])


def finish(spark: SparkSession, commit: Commit) -> None:
    """Make a batch visible. A run that was replaced meanwhile is refused."""
    if commit.epoch is None:
        return
    folder = _Folder(spark, f"{commit.out}/_ledger")
    if max(_epochs(folder)) > commit.epoch:
        raise Fenced(f"epoch {commit.epoch} of {commit.out} has been replaced")
    folder.create(f"done/{commit.epoch}/{commit.batch}", "done")
    for name in folder.names(f"done/{commit.epoch}"):
        if int(name) < commit.batch:
            folder.delete(f"done/{commit.epoch}/{name}")


def _within(number: Column, last: dict[int, int]) -> Column:
    ranges = [number.between(n * EPOCH, n * EPOCH + b) for n, b in last.items()]  # one an epoch
    return reduce(lambda a, b: a | b, ranges, F.lit(False))


def visible(spark: SparkSession, out: str, rows: DataFrame, number: str = "batch") -> DataFrame:
    """The rows of committed batches; all rows if no streaming query has written to ``out``. What is named by a text, such as a
    replay, was not written by a streaming query and stays."""
    epochs, last = _state(_Folder(spark, f"{out}/_ledger"))
    n = F.col(number).cast("string").try_cast("long")
    return rows.where(n.isNull() | _within(n, last)) if epochs else rows


def _identity(records: DataFrame, shard: Column, sequence: Column, arrival: Column) -> DataFrame:
    return records.select(
        F.coalesce(F.to_date(arrival), F.lit("1970-01-01").cast("date")).alias("day"), shard.cast("string").alias("shard_id"),
        sequence.cast("string").alias("sequence_number"),
    )


def fresh(commit: Commit, records: DataFrame, shard: Column, sequence: Column, arrival: Column) -> DataFrame:
    """The records that no sealed epoch has committed, and a note of those that this batch takes.

    ``arrival`` must not change between deliveries of a record: it names the days that are looked up.
    """
    if commit.epoch is None:
        return records
    spark, path = records.sparkSession, f"{commit.out}/_ledger/taken"
    own = _identity(records, shard, sequence, arrival)
    later = any(b >= 0 for b in commit.sealed.values())
    if later:
        own = own.persist(StorageLevel.MEMORY_AND_DISK)  # its source may be read whole for it
    try:
        new = own
        if later:
            days = own.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
            known = spark.read.schema(TAKEN).parquet(path).where(
                (F.col("epoch") < commit.epoch) & F.col("day").between(F.lit(days["a"]), F.lit(days["b"]))
            )
            known = known.where(_within(F.col("number"), commit.sealed)).select(*[F.col(c).alias(f"__{c}") for c in IDS])
            known = joins.measured(known)
            same = lambda a, b: a.eqNullSafe(F.col("__shard_id")) & b.eqNullSafe(F.col("__sequence_number"))
            new = own.join(known, same(*[F.col(c) for c in IDS]), "left_anti")
            marked = records.withColumns({"__shard": shard.cast("string"), "__sequence": sequence.cast("string")})
            records = marked.join(known, same(F.col("__shard"), F.col("__sequence")), "left_anti").drop("__shard", "__sequence")
        # a repeated batch notes its records again, which changes nothing
        noted = new.select(F.lit(commit.epoch).alias("epoch"), "day", F.lit(commit.number).alias("number"), *IDS).distinct()
        noted.write.mode("append").partitionBy("epoch", "day").parquet(path)
    finally:
        own.unpersist()
    return records


def run(
    records: DataFrame, out: str, batch: int, identity: Identity, work: Callable[[DataFrame, int], Result]
) -> Result | None:
    """``work(records, number)`` for a batch that has not committed yet, without the records of sealed epochs; then commit."""
    spark = records.sparkSession
    commit = begin(spark, out, batch)
    if commit.done:
        return None
    result = work(fresh(commit, records, *identity), commit.number)
    finish(spark, commit)
    return result
