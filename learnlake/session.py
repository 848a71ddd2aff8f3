"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. All can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split an oversized key group even where that costs an exchange later on
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a JSON object that repeats a key keeps the last value, as most JSON readers do
    "spark.sql.variant.allowDuplicateKeys": "true",
    # records and events are long text that is much alike
    "spark.sql.parquet.compression.codec": "zstd",
    # the JVM never compiles a method over 8000 bytes; a stage with one is cut into small methods instead of being interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # events are written whole; guessing columns for their paths costs more than writing and reading them does
    "spark.sql.variant.inferShreddingSchema": "false",
    # the state of a stream lies in files with a bounded cache, not in the heap of the executors
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # records of a stream are wide: each batch of a cache is built whole in the heap
    "spark.sql.inMemoryColumnarStorage.batchSize": "1000",
    # many folders or files are listed by so many tasks at most; with one each, a task costs more than the listing
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "learnlake", cores: int | str = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A temporary folder stands in for it only on a local master; a cluster without the setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="learnlake-")
    return _local_dirs[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: lineage is cut and the planner knows its real size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROW_GROUP = 32 << 20  # bytes of a row group of wide rows; a writer holds one in memory, and it is compressed


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The frame written to the shared folder for as long as it is used, then deleted.

    For wide rows that are read several times, each time a few columns: compressed they take a twentieth of what a cache does,
    and none of the executors' memory.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
