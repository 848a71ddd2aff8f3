"""Historical conversion: old result and object parquet -> result and SCORM result dimensions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from learnlake.operators import shaping
from learnlake.operators.shaping import reshape
from learnlake.schemas import gold
from learnlake.session import scratch_path, written
from learnlake.sinks import ledger
from learnlake.sinks.tables import BUCKETS, load_folder, write_bucketed
from learnlake.sources import files
from learnlake.sources.files import decoded, listing, unprocessed

# Columns cut to 256 bytes.
SHORT_IDS = ("id_system", "statement_id", "lrs_id", "client_id")

# Old column names and the target's.
SHARED_NAMES = {"id_sys": "id_system", "lrs_id": "lrs_id", "client_id": "client_id", "id_statement": "statement_id"}

RESULT_NAMES = SHARED_NAMES | {
    "success": "success_status",
    "interactionType": "interaction_type",
} | {c: c for c in "response duration score_scaled score_raw score_min score_max completion extensions".split()}

SCORM_NAMES = SHARED_NAMES | {
    "scorm&46_correctResponsesPattern": "correct_responses_pattern",
    "scorm&46_response": "response",
    "scorm&46_multipleRecording": "multiple_recording",
    "scorm&46_image": "image",
}


def _typed(table: str, **types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in gold.schema(table).fields])


RESULT_SCHEMA = _typed("gold.dim_lrs_result", success_status=T.BooleanType(), completion=T.BooleanType())
SCORM_SCHEMA = _typed("gold.dim_lrs_result_scorm")


def _keep(df: DataFrame, names) -> DataFrame:
    return df.select(*[f"`{c}`" for c in names if c in df.columns])


def result(results: DataFrame, objects: DataFrame) -> DataFrame:
    """Results of known statements with the object's interaction type."""
    joined = _keep(results, RESULT_NAMES).join(objects.select("id_statement", "interactionType"), "id_statement")
    return reshape(joined, RESULT_NAMES, RESULT_SCHEMA, SHORT_IDS)


def result_scorm(results: DataFrame) -> DataFrame:
    return reshape(_keep(results, SCORM_NAMES), SCORM_NAMES, SCORM_SCHEMA, SHORT_IDS)


def convert(results: DataFrame, objects: DataFrame) -> dict[str, DataFrame]:
    """Both targets from de-duplicated inputs."""
    return _targets(results.distinct(), objects.distinct())


def _targets(results: DataFrame, objects: DataFrame) -> dict[str, DataFrame]:
    return {"dim_lrs_result": result(results, objects), "dim_lrs_result_scorm": result_scorm(results)}


@contextmanager
def _dealt(results: DataFrame, objects: DataFrame, rows: int, database: str) -> Iterator[dict[str, DataFrame]]:
    """Both targets of files' rows, which are shuffled once, by their statement: what is staged lies in buckets of it, so that
    neither the join nor the bucket folders of the targets shuffle them again.

    Rows without a statement are in no target. A bucket is one task and part of one folder; there are as many as ``rows``
    ask for. The staging table is gone when the targets are written.
    """
    spark, n = results.sparkSession, BUCKETS * max(1, -(-rows // (BUCKETS * shaping.SPREAD)))
    path = scratch_path(spark, "results")
    table = f"{database}.staged_{path[-32:]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    every = results.where(F.col("id_statement").isNotNull()).repartition(n, "id_statement").distinct()
    kept = _keep(every, dict.fromkeys([*RESULT_NAMES, *SCORM_NAMES]))
    kept.write.format("parquet").bucketBy(n, "id_statement").option("path", path).saveAsTable(table)
    known = objects.where(F.col("id_statement").isNotNull()).repartition(n, "id_statement").distinct()
    try:
        yield _targets(spark.table(table), known)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def run(spark: SparkSession, results_path: str, objects_path: str, done: DataFrame, out: str, database: str) -> DataFrame:
    """Convert the result files not yet in ``done(path)`` and load both tables; returns the paths to add to ``done``.

    For inputs whose paths are recorded elsewhere; ``follow`` lets the checkpoint do it and reads new files only. The files
    are chosen by a join on their path inside one read of the folder, and the de-duplicated rows are shuffled and
    written once for both targets. A run is named after its files: a run that failed between the two tables, or before its files
    were recorded, replaces what it had written when it is repeated. Tables are created once and gain partitions.
    """
    fresh = written(unprocessed(listing(spark, results_path), done).select("path"), "fresh")
    name = fresh.agg(F.count("*"), F.bit_xor(F.xxhash64("path"))).first()
    if not name[0]:
        return fresh
    run_id = f"{name[0]}-{name[1] & (2**63 - 1):x}"
    every = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(results_path)
    chosen = every.withColumn("__path", F.col("_metadata.file_path")).join(
        fresh.select(_plain(F.col("path")).alias("__fresh")), _plain(decoded(F.col("__path"))) == F.col("__fresh"), "left_semi"
    )
    _all_read(spark, results_path, fresh)
    objects = spark.read.option("recursiveFileLookup", True).parquet(objects_path)
    with _dealt(chosen.drop("__path"), objects, every.count(), database) as targets:
        for table, rows in targets.items():
            stage = f"{out}/{table}/run={run_id}"
            write_bucketed(rows, stage, mode="overwrite", dealt=True)
            load_folder(spark, stage, f"{database}.{table}", rows.schema, f"{out}/{table}", run_id)
    return fresh


def follow(
    spark: SparkSession, results_path: str, objects_path: str, checkpoint: str, out: str, database: str,
    archive: str | None = None, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Convert what has come since the last run: the checkpoint knows the result files that were read, so no old file is
    listed against a table of paths or opened again.

    The new files are one batch unless ``files_per_batch`` cuts them; rows are de-duplicated within a batch. Batches are
    named by the ledger: one that failed between the two tables, or after its files were written, replaces what it had
    written when it is tried again, and a run with a new checkpoint leaves out the files that earlier ones have committed.
    """
    results = files.follow(spark, results_path, archive=archive, files_per_batch=files_per_batch)

    def convert_new(batch: DataFrame, batch_id: int) -> None:
        commit = ledger.begin(spark, out, batch_id)
        if not commit.done:
            fresh = ledger.fresh(commit, batch, F.lit("file"), F.col("__path"), F.lit(None).cast("timestamp"))
            objects = spark.read.option("recursiveFileLookup", True).parquet(objects_path)
            with _dealt(fresh.drop("__path"), objects, batch.count(), database) as targets:
                for table, made in targets.items():
                    write_bucketed(made, f"{out}/{table}/run={commit.number}", mode="overwrite", dealt=True)
            ledger.finish(spark, commit)
        # naming partitions can be repeated: what committed last, also under an older checkpoint, is named again
        ends = [n * ledger.EPOCH + b for n, b in (commit.sealed or {}).items() if b >= 0]
        for number in [*ends, commit.number]:
            for table, schema in (("dim_lrs_result", RESULT_SCHEMA), ("dim_lrs_result_scorm", SCORM_SCHEMA)):
                load_folder(spark, f"{out}/{table}/run={number}", f"{database}.{table}", schema, f"{out}/{table}", str(number))

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    writer = results.writeStream.foreachBatch(lambda df, i: convert_new(df, i) and None)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _all_read(spark: SparkSession, folder: str, fresh: DataFrame) -> None:
    """Fails if a fresh file would not be found by its decoded path: it would be recorded as done without being read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    found = files.select(_plain(decoded(F.col("_metadata.file_path"))).alias("path"))
    lost = fresh.select(_plain(F.col("path")).alias("path")).join(found, "path", "left_anti").limit(3).collect()
    if lost:
        raise ValueError(f"listed files are not read: {[r['path'] for r in lost]}")


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")
