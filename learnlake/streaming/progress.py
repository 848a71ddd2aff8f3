"""Counters of running streams: taken in passing while a micro-batch is written, without reading the data again."""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRIC = "delivery"
SCHEMA = "query string, run string, batch long, shard string, total long, ok long, first_s double, last_s double"
_AGGREGATES = ("total", "ok", "first_s", "last_s")


def counted(stream: DataFrame, ok: Column, shard: Column, shards: Iterable[str], seconds: Column) -> DataFrame:
    """The stream itself; its queries report per shard rows, successes, and the first and last time.

    Shards are those named and, under NULL, all others. The query's sink must read the rows once, as file sinks do: a
    ``foreachBatch`` with several actions would count as often as it reads.
    """
    shards = list(shards)
    of = {str(i): shard.eqNullSafe(F.lit(s)) for i, s in enumerate(shards)}
    of["other"] = ~F.coalesce(shard.isin(shards), F.lit(False))
    metrics = []
    for name, own in of.items():
        taken = F.when(own, seconds)
        values = (F.count_if(own), F.count_if(own & F.coalesce(ok, F.lit(False))), F.min(taken), F.max(taken))
        metrics += [v.alias(f"{a}_{name}") for a, v in zip(_AGGREGATES, values)]
    labels = F.max(F.array(*[F.lit(s) for s in shards]).cast("array<string>")).alias("shards")
    return stream.observe(METRIC, labels, *metrics)


class ProgressTable(StreamingQueryListener):
    """Keeps what ``counted`` streams report, a row for each micro-batch and shard. A repeated batch replaces its rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        spark.streams.addListener(self)

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        at = event.progress
        seen = at.observedMetrics.get(METRIC)
        if seen is None or seen["shards"] is None:  # a batch without rows
            return
        names = {str(i): s for i, s in enumerate(seen["shards"])} | {"other": None}
        rows = [
            (str(at.id), str(at.runId), at.batchId, shard, *(seen[f"{a}_{name}"] for a in _AGGREGATES))
            for name, shard in names.items() if seen[f"total_{name}"]
        ]
        df = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
        df.write.mode("overwrite").parquet(f"{self.path}/source={at.id}/number={at.batchId}")

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until a stopped query's last report is kept."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no report of the end of query {query.id}")

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.path)


def success_counts(progress: DataFrame) -> DataFrame:
    """Per shard: total, successes, failures, success percentage, and rows a second between first and last time."""
    sums = progress.groupBy("shard").agg(
        F.sum("total").alias("total"), F.sum("ok").alias("ok"), (F.max("last_s") - F.min("first_s")).alias("elapsed_s")
    )
    return sums.withColumns({
        "failed": F.col("total") - F.col("ok"),
        "success_rate": F.col("ok") * F.lit(100.0) / F.col("total"),
        "per_second": F.when(F.col("elapsed_s") > 0, F.col("total") / F.col("elapsed_s")),
    })
