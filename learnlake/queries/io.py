"""Source, sink and streaming queries: data is written under the shared folder, read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from learnlake.functions.ids import bucket
from learnlake.functions.paths import at
from learnlake.operators import joins, routing
from learnlake.operators.incremental import run_summary, table_counts
from learnlake.operators.shaping import spread
from learnlake.parallel import attempt
from learnlake.plans import fact, history, lrs_batch, lrs_stream, reading
from learnlake.queries import inputs
from learnlake.queries.admin import ITEMS_SQL, STREAM_SQL, USER_SQL, reading_events, user_attributes, users
from learnlake.queries.inputs import admin_document, envelopes, s
from learnlake.queries.learning import BATCH_KEYS, EVENTS_SQL, HAS_ROWS_SQL, ROUTE_COUNTS_SQL, VERB_SQL
from learnlake.queries.registry import query, table_sql
from learnlake.queries.warehouse import FACT_SQL, fact_tables
from learnlake.schemas import gold
from learnlake.session import scratch_path, written
from learnlake.sinks import archive, ledger, merge, tables
from learnlake.sources import envelope, files
from learnlake.streaming import jobs, progress

HOUR_SQL = "strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour"


def _archived(t, path: str, folders: list[str]) -> DataFrame:
    """Archived records with their folder values as text."""
    return t.spark.read.schema(", ".join(f"{c} string" for c in [*archive.IDENTITY, "payload", *folders])).json(path)


def _events(t) -> DataFrame:
    return envelope.good(envelope.decode(inputs.learning_records(t)))


def _arrived():
    return jobs.arrival_time(F.col("approximateArrivalTimestamp"))


# -- CSV and bucketed parquet ----------------------------------------------------------------------------------------
NOTES = {
    "1-URGENT": ("", "NULL"), "2-HIGH": ("   ", "NULL"),
    "3-MEDIUM": ('say "hi", \\ ok', """'say "hi", \\ ok'"""),
    "4-NOT SPECIFIED": ('line 1\n"line" 2\r\nend\\', """'line 1' || chr(10) || '"line" 2' || chr(13) || chr(10) || 'end\\'"""),
}


@query(
    "q36_csv_nulls",
    "SELECT o_orderkey, CASE "
    + " ".join(f"WHEN o_orderpriority = '{k}' THEN {sql}" for k, (_, sql) in NOTES.items())
    + " ELSE o_orderpriority END AS note, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders",
)
def csv_nulls(t):
    """Written in the bulk-load dialect and read back: blank text is NULL, quotes, backslashes and line breaks survive."""
    priority = F.col("o_orderpriority")
    note = priority
    for k, (text, _) in NOTES.items():
        note = F.when(priority == k, F.lit(text)).otherwise(note)
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    df = t.orders.select("o_orderkey", note.alias("note"), status.alias("status"))
    path = scratch_path(t.spark, "csv")
    tables.write_csv(df, path)
    return tables.load_csv(t.spark, path, df.schema)


@query(
    "csv_rejects",
    "SELECT o_orderkey AS k, CAST(o_orderstatus = 'F' AS BOOLEAN) AS kept FROM orders",
)
def csv_rejects(t):
    """Records that do not fit the schema are parked, none is lost: the loaded and the parked ones together."""
    number = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string")).otherwise(s("x", ".o_orderkey"))
    path = scratch_path(t.spark, "csv")
    tables.write_csv(t.orders.select(number.alias("n"), F.lit("two\nlines").alias("text")), path)
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("text", T.StringType())])
    rows = tables.load_csv(t.spark, path, schema, max_errors=2**62, park=f"{path}-parked")
    parked = t.spark.read.schema("value string").json(f"{path}-parked")
    found = parked.select(F.regexp_extract("value", "x([0-9]+)", 1).cast("long").alias("k"), F.lit(False).alias("kept"))
    return rows.select(F.col("n").alias("k"), F.lit(True).alias("kept")).unionByName(found)


@query(
    "q38_bucket_counts",
    "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS keys, true AS in_range, true AS stable FROM orders",
)
def bucket_counts(t):
    """Rows per bucket add up to all rows, every bucket is one of the fixed number, and a key has one bucket."""
    keyed = t.orders.select(F.col("o_orderkey").cast("string").alias("statement_id"))
    per_key = tables.with_bucket(keyed).groupBy("statement_id").agg(
        F.count("*").alias("n"), F.min("bucket").alias("lo"), F.max("bucket").alias("hi")
    )
    per_bucket = per_key.groupBy("lo").agg(F.sum("n").alias("n"), F.count("*").alias("keys"), F.bool_and(F.col("lo") == F.col("hi")).alias("stable"))
    return per_bucket.agg(
        F.sum("n").alias("n"), F.sum("keys").alias("keys"),
        F.bool_and(F.col("lo").between(0, tables.BUCKETS - 1)).alias("in_range"), F.bool_and("stable").alias("stable"),
    )


@query(
    "bucketed_parquet",
    "SELECT CAST(o_orderkey AS VARCHAR) AS statement_id, o_orderstatus AS response, true AS right_bucket FROM orders",
)
def bucketed_parquet(t):
    """Hash buckets written in one pass; every row, also of negative hashes, comes back from its own bucket."""
    path = scratch_path(t.spark, "buckets")
    df = t.orders.select(F.col("o_orderkey").cast("string").alias("statement_id"), F.col("o_orderstatus").alias("response"))
    tables.write_bucketed(df, path)
    back = t.spark.read.parquet(path)
    return back.select("statement_id", "response", (F.col("bucket") == bucket(F.col("statement_id"), tables.BUCKETS)).alias("right_bucket"))


@query(
    "replace_guarded",
    "SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)",
)
def replace_guarded(t):
    """A full reload that reads the table it replaces; a second, empty reload leaves it alone."""
    base = scratch_path(t.spark, "replace")
    name = f"replace_guarded_{base[-8:]}"
    tables.replace_table(t.spark, t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s")), name, base)
    keys = t.lineitem.select(F.col("l_orderkey").alias("k"))
    tables.replace_if_any(t.spark, t.spark.table(name).join(keys, "k", "left_semi"), name, base)
    tables.replace_if_any(t.spark, t.spark.table(name).where(F.col("k") < F.lit(None)), name, base)
    return t.spark.table(name)


# -- archives --------------------------------------------------------------------------------------------------------
WHEN_SQL = "'03' AS month, '01' AS day, '05' AS hour"


def _when():
    """A fixed processing time; a micro-batch has one."""
    return F.lit("2024-03-01 05:06:07").cast("timestamp")


PRETTY_SQL = "'{' || chr(10) || '  \"id\": \"ev' || event_id || '\",' || chr(10) || '  \"text\": \"a \\\\ b\"' || chr(10) || '}'"
SEQUENCE_SQL = "'4965' || lpad(CAST(event_id AS VARCHAR), 52, '0')"


@query(
    "archive_raw_events",
    f"SELECT {PRETTY_SQL} AS payload, CAST(user_id AS VARCHAR) AS partition_key, {SEQUENCE_SQL} AS sequence_number, "
    f"{WHEN_SQL} FROM events",
)
def archive_raw(t):
    """Payloads over several lines, found again one by one through the ingest log: its folder and the record's identity."""
    path, folders = scratch_path(t.spark, "raw"), ["month", "day", "hour"]
    payload = s('{\n  "id": "ev', ".event_id", '",\n  "text": "a \\\\ b"\n}')
    records = inputs.envelopes(t.events, payload, "event_id", "user_id", "ts")
    events = envelope.good(envelope.decode(records))
    archive.write_json(archive.raw_layout(events, _when()), path, folders)
    log = written(envelope.ingest_log(events, "learning", archive.raw_uri(f"{path}/", _when())), "log")
    files = t.spark.read.schema("partitionKey string, sequenceNumber string, payload string, month string, day string, hour string").json(path)
    folder = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""), "^file:/+", "/")
    found = files.withColumn("folder", folder)
    there = (F.regexp_replace("s3_uri", "^file:/+", "/") == F.col("folder")) & (F.col("partition_key") == F.col("partitionKey"))
    joined = found.join(joins.measured(log), there & (F.col("sequence_number") == F.col("sequenceNumber")))
    return joined.select("payload", "partition_key", "sequence_number", *folders)


@query(
    "archive_processed_learning",
    f"SELECT 'ev' || event_id AS id, {SEQUENCE_SQL} AS sequence_number, verb, 'lrs' || (user_id % 7) AS lrs_id, {WHEN_SQL} "
    f"FROM {EVENTS_SQL} WHERE verb <> 'completed'",
)
def archive_learning(t):
    path, folders = scratch_path(t.spark, "learning"), jobs.LEARNING.folders
    events = _events(t)
    archive.write_json(archive.learning_layout(events.where(jobs.LEARNING.route().isNotNull()), _when()), path, folders)
    return _archived(t, path, folders).select(
        F.get_json_object("payload", "$.id").alias("id"), F.col("sequenceNumber").alias("sequence_number"), *folders
    )


@query("archive_time_folders", f"SELECT 'ev' || event_id AS id, {HOUR_SQL} FROM events")
def archive_times(t):
    """Folder values from the arrival time of each record."""
    rows = archive.raw_layout(_events(t), _arrived())
    return rows.select(F.get_json_object("payload", "$.id").alias("id"), "month", "day", "hour")


@query(
    "archive_admin_layout",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, 'user_created' AS action, '03' AS month, '01' AS day, '05' AS hour FROM customer",
)
def archive_admin(t):
    rows = archive.admin_layout(users(t), _when())
    return rows.select(F.get_json_object("payload", "$.data.attributes.refId").alias("id"), "action", "month", "day", "hour")


@query(
    "archive_reading_layout",
    """SELECT 'act_' || lower(o_orderstatus) AS action, CASE WHEN o_orderstatus = 'P' THEN 'other'
         WHEN o_custkey % 2 = 0 THEN 'acceso' ELSE 'callback' END AS kind, count(*) AS n FROM orders GROUP BY 1, 2""",
)
def archive_reading(t):
    rows = archive.reading_layout(reading_events(t), F.current_timestamp())
    return rows.groupBy("action", "kind").agg(F.count("*").alias("n"))


@query(
    "archive_event_type",
    f"SELECT 'ev' || event_id AS id, {VERB_SQL} AS event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, "
    "strftime(ts, '%d') AS day FROM events",
)
def archive_event_type(t):
    """Normalized events by year, month and event type."""
    from learnlake.functions.keys import normalize

    events = inputs.learning_events(t)
    texts = events.select("ts", F.to_json(normalize(F.col("e"), events.schema["e"].dataType)).alias("payload"))
    docs = texts.withColumn("doc", F.try_parse_json("payload"))
    path, folders = scratch_path(t.spark, "types"), ["year", "month", "event_type"]
    rows = archive.event_type_layout(docs, F.col("ts"))
    archive.write_json(rows, path, folders)
    schema = "payload string, day string, year string, month string, event_type string"
    back = t.spark.read.schema(schema).json(path)
    return back.select(F.get_json_object("payload", "$.id").alias("id"), *folders, "day")


@query("archive_flat", "SELECT event_id, event_type, value FROM events")
def archive_flat(t):
    path = scratch_path(t.spark, "flat")
    archive.write_json(t.events.select("event_id", "event_type", "value"), path, [])
    return t.spark.read.schema("event_id long, event_type string, value double").json(path)


@query(
    "archive_unknown_route",
    f"SELECT 'ev' || event_id AS id, {SEQUENCE_SQL} AS sequence_number FROM {EVENTS_SQL} WHERE verb = 'completed'",
)
def archive_unknown(t):
    path = scratch_path(t.spark, "unknown")
    archive.write_json(archive.plain_layout(lrs_stream.unknown(_events(t))), path, [])
    return _archived(t, path, []).select(
        F.get_json_object("payload", "$.id").alias("id"), F.col("sequenceNumber").alias("sequence_number")
    )


@query(
    "archive_failed_batch",
    "SELECT o_orderkey AS k, o_orderstatus AS s, 'failed' AS status, true AS explained FROM orders",
)
def archive_failed(t):
    """A write that keeps failing is parked under operation, table and batch after its retries, and reported."""
    path = scratch_path(t.spark, "errors")
    rows = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    broken = rows.select(F.raise_error(F.lit("no such column")).cast("string").alias("x"))
    status, error = attempt(
        lambda: broken.write.parquet(f"{path}/target"), lambda: archive.write_failed(rows, path, "gold.dim_session", "insert", "9"), 3
    )
    parked = t.spark.read.schema("k long, s string").json(f"{path}/insert_gold_dim_session/batch=9")
    return parked.select("k", "s", F.lit(status).alias("status"), F.lit(bool(error)).alias("explained"))


@query(
    "raw_table_append",
    f"SELECT 'lrs_events_' || verb AS table_name, 'ev' || event_id AS id, true AS stamped FROM {EVENTS_SQL}",
)
def raw_append(t):
    """Raw tables keep the event as VARIANT parquet, one folder per table."""
    path = scratch_path(t.spark, "lrs_raw")
    raw = inputs.raw_learning(t)
    tables.append_raw(raw.withColumn("table_name", routing.raw_table(routing.verb_normalized("event"))), path)
    back = t.spark.read.parquet(path)
    return back.select("table_name", at("event", "id").alias("id"), F.col("dt_load").isNotNull().alias("stamped"))


@query(
    "raw_table_pruned_read",
    f"SELECT {BATCH_KEYS}, 'user ' || user_id AS actor_name FROM {EVENTS_SQL} WHERE verb = 'answered'",
)
def raw_pruned(t):
    """One raw table read back: the folder filter prunes, the variant paths are pushed into the scan."""
    path = scratch_path(t.spark, "lrs_raw")
    raw = inputs.raw_learning(t)
    tables.append_raw(raw.withColumn("table_name", routing.raw_table(routing.verb_normalized("event"))), path)
    one = t.spark.read.parquet(path).where(F.col("table_name") == "lrs_events_answered")
    return lrs_batch.dimension(one, "dim_lrs_actor").select("statement_id", "lrs_id", "client_id", "actor_name")


@query(
    "table_append_conformed",
    "SELECT CAST(o_orderkey AS VARCHAR) AS session_id, o_orderstatus AS session_code, NULL::VARCHAR AS company_id, true AS stamped FROM orders",
)
def table_append(t):
    """Unmapped columns stay NULL, the load time is stamped, and a repeated batch does not add rows."""
    path = scratch_path(t.spark, "append")
    rows = t.orders.select(F.col("o_orderkey").alias("session_id"), F.col("o_orderstatus").alias("session_code"), "o_custkey")
    for _ in range(2):
        tables.append(rows, "gold.dim_session", path, "1")
    back = t.spark.read.parquet(path)
    return back.select("session_id", "session_code", "company_id", F.col("dt_load").isNotNull().alias("stamped"))


# -- files -----------------------------------------------------------------------------------------------------------
@query("json_documents", "SELECT CAST(c_nationkey AS VARCHAR) AS nation, count(*) AS n, min(c_custkey) AS first FROM customer GROUP BY 1")
def json_documents(t):
    """Files read whole as one document each: customers over several lines inside one object per file."""
    path = scratch_path(t.spark, "documents")
    line = F.to_json(F.struct("c_custkey"))
    rows = t.customer.select("c_nationkey", F.concat(F.lit('{"k":\n'), line, F.lit("}")).alias("value"))
    rows.write.partitionBy("c_nationkey").option("lineSep", ",\n").text(path)
    docs = files.json_documents(t.spark, path)
    texts = docs.select("path", F.concat(F.lit("["), F.rtrim(F.col("payload"), F.lit(",\n")), F.lit("]")).alias("text"))
    ids = F.from_json("text", "array<struct<k:struct<c_custkey:bigint>>>")
    flat = texts.select(F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).alias("nation"), F.explode(ids).alias("x"))
    return flat.groupBy("nation").agg(F.count("*").alias("n"), F.min("x.k.c_custkey").alias("first"))


@query("json_file_profile", "SELECT event_type, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY 1")
def json_profile(t):
    """Records per file of line-delimited JSON, summed per folder."""
    path = scratch_path(t.spark, "profile")
    t.events.select("event_type", F.col("props").alias("value")).write.partitionBy("event_type").text(path)
    counts = files.profile_json(t.spark, path, "*.txt")
    kind = F.regexp_extract("path", "event_type=([a-z]+)", 1)
    return counts.groupBy(kind.alias("event_type")).agg(F.sum("records").alias("records"))


@query("json_document_profile", "SELECT event_type, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY 1")
def json_document_profile(t):
    """Items of files that are one list over many lines each, summed per folder."""
    path = scratch_path(t.spark, "profile")
    group = Window.partitionBy("event_type", "part").orderBy("event_id", "user_id", "props")
    rows = t.events.select("event_type", "event_id", "user_id", "props", F.pmod(F.xxhash64("event_id"), F.lit(16)).alias("part"))
    placed = rows.select("event_type", "part", "props", F.lag("props").over(group).isNull().alias("first"), F.lead("props").over(group).isNull().alias("last"))
    text = F.concat(F.when(F.col("first"), "[").otherwise(""), F.lit('{"item":\n'), F.col("props"), F.when(F.col("last"), "}\n]").otherwise("},"))
    placed.select("event_type", "part", text.alias("value")).write.partitionBy("event_type", "part").text(path)
    counts = files.profile_json(t.spark, path, "*.txt")
    kind = F.regexp_extract("path", "event_type=([a-z]+)", 1)
    return counts.groupBy(kind.alias("event_type")).agg(F.sum("records").alias("records"))


@query(
    "history_partitions",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id_statement, o_orderstatus AS owner, "
    "CASE WHEN o_custkey % 2 = 0 THEN '2024' ELSE '2025' END AS year FROM orders",
)
def history_partitions(t):
    """``<base>/<owner>/<year>/results/`` folders; owner and year come from the path."""
    base, years = scratch_path(t.spark, "history"), ["2024", "2025"]
    year = F.when(F.col("o_custkey") % 2 == 0, "2024").otherwise("2025")
    owners = [r[0] for r in t.orders.select("o_orderstatus").distinct().collect()]  # the few statuses there are
    for o in owners:
        for y in years:
            part = t.orders.where(F.col("o_orderstatus").eqNullSafe(F.lit(o)) & (year == y))
            part.select(F.col("o_orderkey").cast("string").alias("id_statement")).write.parquet(files.history_path(base, str(o), y))
    return files.history(t.spark, base, [str(o) for o in owners], years, "results")


# -- whole jobs ------------------------------------------------------------------------------------------------------
REFRESH_SQL = f"""WITH e AS {EVENTS_SQL}, n AS (
      SELECT unnest(['dim_lrs_actor', 'dim_lrs_object', 'dim_lrs_object_http', 'dim_lrs_result', 'dim_lrs_statement',
        'dim_lrs_verb', 'dim_lrs_authority', 'dim_lrs_context', 'dim_lrs_result_scorm']) AS table_name)"""


def _refreshed(t) -> tuple[str, DataFrame]:
    """All nine dimensions loaded in two increments from a raw table in load days; the last increment's summary."""
    base = scratch_path(t.spark, "refresh")
    database = f"refresh_{base[-8:]}"
    events = inputs.raw_learning(t).withColumn("dt_load", F.col("dt_load").cast("timestamp"))
    tables.append_raw(events.withColumn("table_name", F.lit(routing.CATCH_ALL)), f"{base}/raw")
    raw = t.spark.read.parquet(f"{base}/raw")
    marks = raw.agg(F.percentile_approx(F.unix_seconds("dt_load"), 0.4).alias("m"), F.max("dt_load").alias("hi")).first()
    lrs_batch.refresh(t.spark, raw, database, base, F.timestamp_seconds(F.lit(marks["m"])))
    return database, lrs_batch.refresh(t.spark, raw, database, base, F.lit(marks["hi"]))


@query(
    "batch_refresh_summary",
    f"""{REFRESH_SQL},
        c AS (SELECT table_name, (SELECT count(*) FILTER (table_name <> 'dim_lrs_object_http' OR verb = 'answered') FROM e) AS n FROM n)
        SELECT table_name, CAST(n AS BIGINT) AS n, 'ok' AS status FROM c
        UNION ALL SELECT 'TOTAL', CAST(sum(n) AS BIGINT), 'ok' FROM c""",
)
def batch_refresh(t):
    """Every event arrives exactly once in two increments."""
    database, last = _refreshed(t)
    frames = {name: t.spark.table(f"{database}.{name}") for name in lrs_batch.DIMENSIONS}
    return run_summary(table_counts(frames).join(last.select("table_name", "status"), "table_name"))


@query(
    "batch_refresh_rows",
    f"""{REFRESH_SQL} SELECT table_name, 'ev' || event_id AS statement_id, 'lrs' || (user_id % 7) AS lrs_id
        FROM n, e WHERE table_name <> 'dim_lrs_object_http' OR verb = 'answered'""",
)
def batch_refresh_rows(t):
    """The rows of the nine dimensions after two increments."""
    database, _ = _refreshed(t)
    frames = [t.spark.table(f"{database}.{n}").select(F.lit(n).alias("table_name"), "statement_id", "lrs_id") for n in lrs_batch.DIMENSIONS]
    return files.union_all(frames)


LINE_SQL = "CAST(l_orderkey AS VARCHAR) || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' || l_returnflag"


HISTORY_SQL = f"""WITH l AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS statement_id, {LINE_SQL} AS response FROM lineitem)
        SELECT 'dim_lrs_result_scorm' AS table_name, statement_id, response FROM l UNION ALL
        SELECT 'dim_lrs_result', statement_id, response FROM l
          WHERE statement_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)"""


def _old_results(t) -> tuple[DataFrame, DataFrame]:
    """Result and object rows as they lie in the old files."""
    line = s(".l_orderkey", "|", ".l_linenumber", "|", ".l_partkey", "|", ".l_suppkey", "|", ".l_returnflag")
    lines = t.lineitem.select(
        line.alias("response"), F.lit("sys").alias("id_sys"), F.lit("l").alias("lrs_id"), F.lit("c").alias("client_id"),
        F.col("l_orderkey").cast("string").alias("id_statement"), line.alias("scorm&46_response"),
    )
    return lines, t.orders.select(F.col("o_orderkey").cast("string").alias("id_statement"), F.lit("choice").alias("interactionType"))


@query("history_stream", HISTORY_SQL)
def history_stream(t):
    """The conversion as a job that follows its folder: two runs with a file each to read, one with nothing new, and one that
    starts with a new checkpoint; every row is in its table once."""
    out = scratch_path(t.spark, "conversion")
    database = f"history_{out[-8:]}"
    lines, objects = _old_results(t)
    objects.write.parquet(f"{out}/in/objects")
    first = F.pmod(F.xxhash64("response"), F.lit(2)) == 0  # equal rows come in the same file
    for part, checkpoint in ((first, "a"), (~first, "a"), (None, "a"), (None, "b")):
        if part is not None:
            lines.where(part).write.mode("append").parquet(f"{out}/in/results")
        history.follow(
            t.spark, f"{out}/in/results", f"{out}/in/objects", f"{out}/checkpoint-{checkpoint}", f"{out}/tables", database
        ).awaitTermination()
    tables_of = ("dim_lrs_result", "dim_lrs_result_scorm")
    frames = [t.spark.table(f"{database}.{n}").select(F.lit(n).alias("table_name"), "statement_id", "response") for n in tables_of]
    return frames[0].unionByName(frames[1])


@query(
    "history_job",
    HISTORY_SQL,
)
def history_job(t):
    """Conversion from files to registered, bucketed tables, row by row.

    It runs three times: once failing between the two tables, once to the end, and once with nothing left to do.
    """
    out = scratch_path(t.spark, "conversion")
    database = f"history_{out[-8:]}"
    lines, objects = _old_results(t)
    lines.write.parquet(f"{out}/in/results")
    objects.write.parquet(f"{out}/in/objects")
    done = t.spark.createDataFrame([], "path string")
    # a table of another shape stands in the way of the second target, so the first run fails between the two
    t.spark.sql(f"CREATE DATABASE {database}")
    t.spark.range(1).write.saveAsTable(f"{database}.dim_lrs_result_scorm", path=f"{out}/wrong")
    try:
        history.run(t.spark, f"{out}/in/results", f"{out}/in/objects", done, f"{out}/tables", database)
        raise AssertionError("the run should have failed")
    except AnalysisException:
        t.spark.sql(f"DROP TABLE {database}.dim_lrs_result_scorm")
    for _ in range(2):
        new = written(history.run(t.spark, f"{out}/in/results", f"{out}/in/objects", done, f"{out}/tables", database), "done")
        done = done.unionByName(new)
    tables_of = ("dim_lrs_result", "dim_lrs_result_scorm")
    frames = [t.spark.table(f"{database}.{n}").select(F.lit(n).alias("table_name"), "statement_id", "response") for n in tables_of]
    return frames[0].unionByName(frames[1])


@query("fact_load", FACT_SQL)
def fact_load(t):
    """The fact built and put in place of the previous table, row by row."""
    base = scratch_path(t.spark, "fact")
    name = f"fact_{base[-8:]}"
    fact.load(t.spark, fact_tables(t), name, base)
    return t.spark.table(name).withColumn("score_raw", F.col("score_raw").cast("double"))


@query(
    "raw_table_single_route",
    "SELECT 'lrs_events_all' AS table_name, count(*) AS n FROM events",
)
def raw_single(t):
    """Every event into one raw table, whatever its verb."""
    path = scratch_path(t.spark, "lrs_single")
    tables.append_raw(inputs.raw_learning(t).withColumn("table_name", F.lit(routing.CATCH_ALL)), path)
    return t.spark.read.parquet(path).groupBy("table_name").agg(F.count("*").alias("n"))


# -- streaming -------------------------------------------------------------------------------------------------------
def _record_stream(t, records: DataFrame, batches: int = 2) -> DataFrame:
    """A stream over the records, a file for each task that makes them: wide records are not dealt out again."""
    path = scratch_path(t.spark, "records")
    records.write.parquet(path)
    number = len(t.spark.read.schema(records.schema).parquet(path).inputFiles())
    return jobs.source(t.spark, path, records.schema, "parquet", max(1, -(-number // batches)))


def _stream_of_parts(t, parts: list[DataFrame], handler) -> None:
    """A stream with a batch for each part: the job runs under one checkpoint after each of them has come."""
    inbox, checkpoint = scratch_path(t.spark, "records"), scratch_path(t.spark, "cp")
    for part in parts:
        part.write.mode("append").parquet(inbox)
        stream = t.spark.readStream.schema(part.schema).parquet(inbox)  # all files that are there
        handler(stream, checkpoint).awaitTermination()


@query("q40_stream_route", ROUTE_COUNTS_SQL)
def stream_route(t):
    """Routing counts of a file stream in two micro-batches, equal to the batch counts."""
    out = scratch_path(t.spark, "routes")

    def handle(batch: DataFrame, batch_id: int) -> None:
        docs = envelope.good(envelope.decode(batch))
        routed = docs.select(routing.stream_route(routing.verb_id_only("doc")).alias("route"))
        routing.route_counts(routed).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    jobs.start(_record_stream(t, inputs.learning_records(t)), handle, scratch_path(t.spark, "cp")).awaitTermination()
    return t.spark.read.parquet(out).groupBy("route").agg(F.sum("n").alias("n"))


STREAM_TABLES = {
    "gold.dim_lrs_statement": "has", "gold.dim_lrs_verb": "has", "gold.dim_lrs_object_http": "has",
    "gold.dim_lrs_result": "verb = 'terminated' AND k % 2 = 1",
    "gold.dim_lrs_result_scorm": "verb = 'answered' AND k % 3 IN (0, 1)",
}
ARCHIVES = {"raw": "true", "processed": "verb <> 'completed'", "unknown": "verb = 'completed'"}


@query(
    "stream_learning_job",
    f"WITH e AS (SELECT *, {HAS_ROWS_SQL} AS has FROM {EVENTS_SQL}) "
    + " UNION ALL ".join(
        [f"SELECT '{n}' AS name, 'st' || event_id AS id FROM e WHERE {c}" for n, c in STREAM_TABLES.items()]
        + [f"SELECT '{n}', {SEQUENCE_SQL} FROM e WHERE {c}" for n, c in ARCHIVES.items()]
        + [f"SELECT 'infrastructure.kinesis_log', {SEQUENCE_SQL} FROM e"]
    ),
)
def stream_learning_job(t):
    """The whole learning job over a file stream: the rows of archives, log and five tables."""
    out = scratch_path(t.spark, "job")
    records = _record_stream(t, inputs.learning_records(t))
    jobs.start(
        records, lambda df, batch_id: jobs.run_batch(jobs.LEARNING, df, batch_id, out), scratch_path(t.spark, "cp")
    ).awaitTermination()
    ids = {n: t.spark.read.parquet(f"{out}/tables/{n}").select(F.col("statement_id").alias("id")) for n in lrs_stream.TARGETS}
    log = "infrastructure.kinesis_log"
    ids[log] = t.spark.read.parquet(f"{out}/tables/{log}").select(F.col("sequence_number").alias("id"))
    for n in ARCHIVES:
        archived = t.spark.read.schema("sequenceNumber string").option("recursiveFileLookup", True).json(f"{out}/{n}")
        ids[n] = archived.select(F.col("sequenceNumber").alias("id"))
    return files.union_all([df.select(F.lit(n).alias("name"), "id") for n, df in ids.items()])


@query(
    "stream_created_job",
    table_sql("gold.dim_user", USER_SQL, "FROM customer"),
)
def stream_created_job(t):
    """The created-events job over a file stream: the rows of the user table."""
    out = scratch_path(t.spark, "created")
    events = admin_document(spread(t.customer, "c_custkey"), "USER", user_attributes(), "c_custkey")
    records = envelopes(events.withColumn("at", F.timestamp_seconds("c_custkey")), F.col("payload"), "c_custkey", "c_custkey", "at")
    jobs.start(
        _record_stream(t, records), lambda df, i: jobs.run_batch(jobs.ADMIN_CREATED, df, i, out), scratch_path(t.spark, "cp")
    ).awaitTermination()
    return t.spark.read.parquet(f"{out}/tables/gold.dim_user").select(*gold.data_columns("gold.dim_user"))


@query("stream_reading_job", table_sql(reading.TABLE, STREAM_SQL, f"FROM {ITEMS_SQL} WHERE o_orderstatus <> 'P'"))
def stream_reading_job(t):
    """The reading-plan job over a file stream: the rows of its table."""
    out = scratch_path(t.spark, "reading")
    events = reading_events(t).select("payload", F.xxhash64("payload").alias("n"))
    numbered = events.withColumn("n", F.pmod("n", F.lit(10**15))).withColumn("at", F.lit("2024-03-01").cast("timestamp"))
    records = envelopes(numbered, F.col("payload"), "n", "n", "at")
    jobs.start(
        _record_stream(t, records), lambda df, i: jobs.run_batch(jobs.READING, df, i, out), scratch_path(t.spark, "cp")
    ).awaitTermination()
    return t.spark.read.parquet(f"{out}/tables/{reading.TABLE}").select(*gold.data_columns(reading.TABLE))


@query(
    "stream_reading_queue",
    f"""WITH rows AS (SELECT o_orderkey || '-' || i AS id, n > 1 AND o_orderstatus = 'F' AS gone, o_orderstatus AS role
          FROM {ITEMS_SQL})
        SELECT id, role FROM rows WHERE NOT gone AND id NOT IN (SELECT id FROM rows WHERE gone)""",
)
def stream_reading_queue(t):
    """The queue job over a stream of messages: appended rows without those that deletes name."""
    out = scratch_path(t.spark, "queue")
    body = F.to_json(F.struct(F.base64(F.encode("payload", "UTF-8")).alias("data")))
    messages = reading_events(t).select(F.sha1("payload").alias("messageId"), body.alias("body"))
    jobs.start(
        _record_stream(t, messages), lambda df, i: jobs.run_queue_batch(df, i, out), scratch_path(t.spark, "cp")
    ).awaitTermination()
    return jobs.queue_table(t.spark, out).select("id", "role")


HALF_SQL = "(SELECT to_timestamp(floor((epoch(min(ts)) + epoch(max(ts))) / 2)) AT TIME ZONE 'UTC' AS half FROM events)"


@query(
    "stream_raw_replay",
    f"""SELECT 'lrs_events_' || verb AS table_name, 'ev' || event_id AS id,
          CASE WHEN ts < half THEN 'replay' ELSE 'stream' END AS origin
        FROM {EVENTS_SQL} AS e, {HALF_SQL} AS h""",
)
def stream_raw_replay(t):
    """Raw ingest over a file stream, then the replay: records over the age limit are named by notices, found in the
    stream's log by shard and sequence range, and loaded; every event is in its raw table once."""
    out = scratch_path(t.spark, "raw_ingest")
    log = written(inputs.learning_records(t), "log")
    ends = t.events.agg(F.unix_seconds(F.min("ts").cast("timestamp")), F.unix_seconds(F.max("ts").cast("timestamp"))).first()
    now = F.timestamp_seconds(F.lit((ends[0] + ends[1]) // 2 + jobs.MAX_RECORD_AGE_S))
    jobs.start(
        _record_stream(t, log), lambda df, i: jobs.run_raw_batch(df, i, out, now=now), scratch_path(t.spark, "cp")
    ).awaitTermination()
    for _ in range(2):  # a repeated replay adds nothing
        jobs.replay_raw(log, out)
    raw = jobs.raw_tables(t.spark, out)
    origin = F.when(F.startswith(F.col("batch"), F.lit("replay")), "replay").otherwise("stream")
    return raw.select("table_name", at("event", "id").alias("id"), origin.alias("origin"))


CHANGES_SQL = """WITH ch AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
           FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')
       SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS first_name FROM ch
       WHERE rn = 1 AND o_orderstatus = 'O'"""


def _change_records(t) -> tuple[DataFrame, list]:
    """Updates and deletes of users, one for each order, and the conditions that cut them into an early and a late half."""
    status = F.col("o_orderstatus")
    action = F.when(status == "F", "user_deleted").when(status == "O", "user_updated").otherwise("user_created")
    joined = spread(t.orders, "o_orderkey").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "at", F.timestamp_seconds(F.col("o_orderkey"))
    )
    attributes = user_attributes().withField("name.firstName", F.col("o_orderpriority"))
    events = admin_document(joined, "USER", attributes, "o_orderkey", "c_custkey", "at", action=action)
    records = envelopes(events, F.col("payload"), "o_orderkey", "c_custkey", "at")
    middle = t.orders.agg(F.percentile_approx("o_orderkey", 0.5).alias("m")).first()["m"]
    early = F.col("approximateArrivalTimestamp") <= middle
    return records, [early, ~early]


ONE_TABLE = jobs.Job(
    "admin_changes", {"gold.dim_user": jobs.ADMIN_CHANGES.targets["gold.dim_user"]}, jobs.ADMIN_CHANGES.route,
    jobs.ADMIN_CHANGES.admit, jobs.ADMIN_CHANGES.layout, jobs.ADMIN_CHANGES.folders,
)


@query("stream_change_job", CHANGES_SQL)
def stream_change_job(t):
    """A stream of two micro-batches of updates and deletes merged into the user table; orders arrive by key."""
    out = scratch_path(t.spark, "changes")
    database = f"changes_{out[-8:]}"
    records, halves = _change_records(t)
    merge_batch = lambda df, i: jobs.run_change_batch(ONE_TABLE, df, i, out, database=database)
    _stream_of_parts(t, [records.where(part) for part in halves], lambda stream, cp: jobs.start(stream, merge_batch, cp))
    return merge.read(t.spark, f"{database}.dim_user").select("user_id", "first_name")


@query("stream_change_replay", CHANGES_SQL)
def stream_change_replay(t):
    """The late half of the changes is merged and compacted before the early half comes, and then comes again: older changes
    alter nothing, also not for the users that the newer ones deleted."""
    out = scratch_path(t.spark, "changes")
    database = f"changes_{out[-8:]}"
    records, (early, late) = _change_records(t)
    for i, part in enumerate((late, early, late, early)):
        jobs.run_change_batch(ONE_TABLE, records.where(part), i, out, database=database)
        if i != 1:
            merge.compact(t.spark, f"{database}.dim_user")
    return merge.read(t.spark, f"{database}.dim_user").select("user_id", "first_name")


@query(
    "stream_new_checkpoint",
    f"""SELECT 'raw' AS sink, 'ev' || event_id AS id FROM events
        UNION ALL SELECT 'verb', 'st' || event_id FROM {EVENTS_SQL} WHERE {HAS_ROWS_SQL}
        UNION ALL SELECT 'log', {SEQUENCE_SQL} FROM events""",
)
def stream_new_checkpoint(t):
    """Two jobs drain half of a stream, lose their checkpoints and drain all of it again, from the start: raw tables, a
    dimension and the ingest log have every record once."""
    out, inbox = scratch_path(t.spark, "restart"), scratch_path(t.spark, "records")
    records = inputs.learning_records(t)
    now = F.lit("1970-01-01").cast("timestamp")  # nothing is late
    for part in (F.xxhash64("eventID") % 2 == 0, F.xxhash64("eventID") % 2 != 0):
        records.where(part).write.mode("append").parquet(inbox)
        number = len(t.spark.read.schema(records.schema).parquet(inbox).inputFiles())
        for name, handle in {
            "raw": lambda df, i: jobs.run_raw_batch(df, i, f"{out}/raw", now=now),
            "learning": lambda df, i: jobs.run_batch(jobs.LEARNING, df, i, f"{out}/learning"),
        }.items():
            stream = jobs.source(t.spark, inbox, records.schema, "parquet", max(1, -(-2 * number // 3)))
            jobs.start(stream, handle, scratch_path(t.spark, f"checkpoint-{name}")).awaitTermination()
    table = lambda n: ledger.visible(t.spark, f"{out}/learning", t.spark.read.parquet(f"{out}/learning/tables/{n}"))
    return files.union_all([
        jobs.raw_tables(t.spark, f"{out}/raw").select(F.lit("raw").alias("sink"), at("event", "id").alias("id")),
        table("gold.dim_lrs_verb").select(F.lit("verb").alias("sink"), F.col("statement_id").alias("id")),
        table("infrastructure.kinesis_log").select(F.lit("log").alias("sink"), F.col("sequence_number").alias("id")),
    ])


@query(
    "stream_delivered_twice",
    f"""SELECT 'lrs_events_' || verb AS table_name, 'ev' || event_id AS id FROM {EVENTS_SQL}""",
)
def stream_delivered_twice(t):
    """Every record is delivered in two of three batches; the raw tables have it once."""
    out, inbox = scratch_path(t.spark, "twice"), scratch_path(t.spark, "records")
    records = inputs.learning_records(t)
    third = F.pmod(F.xxhash64("eventID"), F.lit(3))
    for i in range(3):  # as many files each, one a task, so that they are three batches
        records.where((third == i) | (third == (i + 1) % 3)).write.mode("append").parquet(inbox)
    number = len(t.spark.read.schema(records.schema).parquet(inbox).inputFiles())
    ends = t.events.agg(F.datediff(F.max("ts"), F.min("ts")).alias("days")).first()
    source = jobs.source(t.spark, inbox, records.schema, "parquet", max(1, -(-number // 3)))
    stream = jobs.deliver_once(source, f"{ends['days'] + 1} days")
    now = F.lit("1970-01-01").cast("timestamp")  # nothing is late
    ingest = jobs.read_once(lambda df, i: jobs.run_raw_batch(df, i, out, now=now))
    jobs.start(stream, ingest, scratch_path(t.spark, "cp")).awaitTermination()
    return jobs.raw_tables(t.spark, out).select("table_name", at("event", "id").alias("id"))


@query(
    "stream_object_files",
    f"""SELECT 'lrs_events_' || verb AS name, 'ev' || event_id AS id FROM {EVENTS_SQL}
        UNION ALL SELECT DISTINCT 'objects', 'a+' || (event_id // 64) FROM events""",
)
def stream_object_files(t):
    """Object files of 64 events each, ingested as a stream, then again under a new checkpoint beside one that is not JSON:
    the events of the raw tables, and the files by name."""
    out, inbox = scratch_path(t.spark, "objects"), scratch_path(t.spark, "inbox")
    part = F.concat(F.lit("a+"), F.floor(F.col("event_id") / 64).cast("string")).alias("part")
    grouped = inputs.learning_events(t).groupBy(part).agg(F.collect_list("e").alias("e"))  # 64 events a file
    archive.write_objects(grouped.select("part", F.to_json("e").alias("value")), inbox, "part")
    for run in range(2):
        stream = files.follow_documents(t.spark, inbox, None if run else jobs.OBJECTS_PER_BATCH)
        jobs.start(stream, lambda df, i: jobs.run_object_batch(df, i, out), scratch_path(t.spark, "cp")).awaitTermination()
        t.spark.range(1).select(F.lit("{").alias("value")).write.mode("append").text(f"{inbox}/part=broken")
    rows = jobs.raw_tables(t.spark, out).select(F.col("table_name").alias("name"), at("event", "id").alias("id"))
    objects = ledger.visible(t.spark, out, t.spark.read.parquet(f"{out}/objects")).where("events > 0")
    return rows.unionByName(objects.select(F.lit("objects").alias("name"), F.regexp_extract("path", "part=([^/]+)/", 1).alias("id")))


@query(
    "stream_progress_counts",
    """SELECT CAST(user_id % 4 AS VARCHAR) AS shard, count(*) AS total, count(*) FILTER (event_type <> 'error') AS ok,
         count(*) FILTER (event_type = 'error') AS failed,
         count(*) FILTER (event_type <> 'error') * 100.0::DOUBLE / count(*) AS success_rate FROM events GROUP BY 1""",
)
def stream_progress_counts(t):
    """Successes per shard as the stream's own counters report them, batch by batch, while it writes its rows."""
    out = scratch_path(t.spark, "counted")
    events = t.events.select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    shard = (F.col("user_id") % 4).cast("string")
    stream = progress.counted(
        _record_stream(t, spread(events, "us")), F.col("event_type") != "error", shard, "0123", F.col("us") / 1_000_000
    )
    table = progress.ProgressTable(t.spark, f"{out}/progress")
    try:
        sink = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
        table.wait(sink.start(f"{out}/rows"))
    finally:
        table.close()
    return progress.success_counts(table.read()).drop("elapsed_s", "per_second")


@query("fact_over_buckets", FACT_SQL)
def fact_over_buckets(t):
    """The fact over inputs that lie in buckets of the statement key: none of them is shuffled."""
    out = scratch_path(t.spark, "keyed")
    given = fact_tables(t)
    buckets = max(16, -(-t.lineitem.count() // fact.BUCKET_ROWS))
    return fact.build(fact.keep(given, f"keyed_{out[-8:]}", out, buckets))
