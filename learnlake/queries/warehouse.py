"""Fact, join, aggregate, shaping, incremental and change queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.functions import ids, text
from learnlake.operators import changes, incremental, joins, reports, shaping
from learnlake.plans import fact, history
from learnlake.queries.inputs import K_SQL, s
from learnlake.queries.registry import query
from learnlake.schemas import gold
from learnlake.schemas.events import SCORM
from learnlake.sources.files import largest


# -- fact -----------------------------------------------------------------------------------------------------------
def fact_tables(t) -> dict[str, DataFrame]:
    """Order lines play activity rows, orders their statements and results, parts the units, suppliers the schools."""
    orders = t.orders.select(
        (F.col("o_orderkey") % 10).cast("string").alias("lrs_id"),
        (F.col("o_orderkey") % 4).cast("string").alias("client_id"),
        F.col("o_orderkey").cast("string").alias("statement_id"),
        "*",
    )
    answered = orders.where(F.col("o_orderpriority") != "5-LOW")
    lines, part, supplier = t.lineitem, t.part, t.supplier
    text_of = lambda c: F.col(c).cast("string")
    return {
        "dim_lrs_verb": orders.select(
            *fact.KEY, F.when(F.col("o_orderstatus") == "F", fact.ANSWERED).otherwise("other").alias("verb_id")
        ),
        "dim_lrs_object_http": lines.select(
            (F.col("l_orderkey") % 10).cast("string").alias("lrs_id"),
            (F.col("l_orderkey") % 4).cast("string").alias("client_id"),
            text_of("l_orderkey").alias("statement_id"),
            text_of("l_linenumber").alias("object_id"),
            text_of("l_suppkey").alias("student_id"),
            text_of("l_partkey").alias("school_class_id"),
            text_of("l_suppkey").alias("school_id"),
            F.col("l_returnflag").alias("subject_grade_id"),
            F.col("l_linestatus").alias("page_id"),
            s("a", ".l_partkey").alias("activity_id"),
            F.lit("r1").alias("role_id"),
            s("s", ".l_linenumber").alias("section_subject_id"),
            F.when(F.col("l_linenumber") == 1, "-1").otherwise(text_of("l_linenumber")).alias("learning_objective_id"),
            F.when(F.col("l_returnflag") == "R", "-1").otherwise(F.col("l_returnflag")).alias("learning_level_id"),
            F.when(F.col("l_linenumber") != 2, F.floor(F.col("l_partkey") / 2).cast("string")).alias("learning_unit_id"),
        ),
        "dim_lrs_result": answered.select(
            *fact.KEY,
            F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_totalprice") > 150000).alias("success_status"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "None").otherwise(text_of("o_custkey")).alias("score_raw"),
            F.when(F.col("o_orderpriority") == "2-HIGH", "other").otherwise("choice").alias("interaction_type"),
            F.when(F.col("o_orderpriority") == "1-URGENT", SCORM).alias("extensions"),
            F.col("o_orderpriority").alias("response"),
        ),
        "dim_lrs_result_scorm": orders.select(
            *fact.KEY,
            s("p", ".o_custkey").alias("correct_responses_pattern"),
            s("sr", ".o_custkey").alias("response"),
            s("img", ".o_custkey").alias("image"),
        ),
        "dim_lrs_statement": orders.select(*fact.KEY, F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt_time")),
        "dim_page": part.select(
            text_of("p_partkey").alias("page_id"), F.floor(F.col("p_partkey") / 2).cast("string").alias("learning_unit_id")
        ),
        "dim_resource": part.select(s("res", ".p_partkey").alias("resource_id"), text_of("p_partkey").alias("page_id")),
        "dim_activity": part.select(
            s("res", ".p_partkey").alias("resource_id"),
            F.col("p_type").alias("activity_type"),
            F.col("p_size").alias("activity_attempts"),
        ),
        "dim_school": supplier.select(text_of("s_suppkey").alias("school_id"), text_of("s_suppkey").alias("school_id_system")),
        "dim_school_level_session": supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            text_of("s_suppkey").alias("school_id"),
            F.col("n_name").alias("session_id"),
            (F.col("s_acctbal") > 0).alias("active_status"),
        ),
    }


FACT_SQL = f"""
WITH base AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')),
  results AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'),
  units AS (SELECT p_partkey // 2 AS unit, max(p_type) AS activity_type, max(p_size) AS attempts FROM part GROUP BY 1),
  active AS (SELECT s_suppkey, max(n_name) AS session_id, true AS session_active
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0 GROUP BY s_suppkey)
SELECT DISTINCT CAST(b.l_orderkey % 10 AS VARCHAR) AS lrs_id, CAST(b.l_orderkey % 4 AS VARCHAR) AS client_id,
  CAST(b.l_orderkey AS VARCHAR) AS statement_id, CAST(b.l_linenumber AS VARCHAR) AS object_id, a.session_id,
  coalesce(a.session_active, false) AS session_active, CAST(b.l_suppkey AS VARCHAR) AS student_code,
  '00000000-0000-1000-0000-' || lpad(CAST(b.l_suppkey AS VARCHAR), 12, '0') AS student_id,
  CAST(b.l_partkey AS VARCHAR) AS school_class_code,
  '00000000-0000-1000-0000-' || lpad(CAST(b.l_partkey AS VARCHAR), 12, '0') AS school_class_id,
  CAST(b.l_suppkey AS VARCHAR) AS school_code,
  '00000000-0000-1000-0000-' || lpad(CAST(b.l_suppkey AS VARCHAR), 12, '0') AS school_id,
  b.l_returnflag AS subject_grade_id, b.l_linestatus AS page_id, 'a' || b.l_partkey AS activity_id, 'r1' AS role_id,
  's' || b.l_linenumber AS section_subject_id,
  CASE WHEN b.l_linenumber <> 1 THEN CAST(b.l_linenumber AS VARCHAR) END AS learning_objective_id,
  CASE WHEN b.l_returnflag <> 'R' THEN b.l_returnflag END AS learning_level_id,
  'p' || o.o_custkey AS correct_responses_pattern,
  CASE WHEN r.o_orderpriority <> '1-URGENT' THEN CAST(r.o_custkey AS DOUBLE) END AS score_raw,
  coalesce(CASE WHEN r.o_orderpriority <> '3-MEDIUM' THEN r.o_totalprice > 150000 END, false) AS success_status,
  CASE WHEN r.o_orderpriority = '1-URGENT' THEN 'sr' || o.o_custkey ELSE 'img' || o.o_custkey END AS text_response,
  CASE WHEN r.o_orderpriority = '2-HIGH' THEN 'image' ELSE r.o_orderpriority END AS response,
  CASE WHEN b.l_linenumber <> 2 THEN CAST(b.l_partkey // 2 AS VARCHAR) END AS learning_unit_id,
  CAST(coalesce(u.attempts, 0) AS INTEGER) AS attempts, coalesce(u.activity_type, '') AS activity_type,
  0 AS evaluable, false AS evaluated, strftime(o.o_orderdate, '%Y-%m-%d') AS dt_time
FROM base b JOIN orders o ON b.l_orderkey = o.o_orderkey LEFT JOIN results r ON b.l_orderkey = r.o_orderkey
LEFT JOIN units u ON b.l_linenumber <> 2 AND b.l_partkey // 2 = u.unit LEFT JOIN active a ON b.l_suppkey = a.s_suppkey
"""


@query("q01_fact_star", FACT_SQL)
def fact_star(t):
    """The 30-column student response activity fact."""
    return fact.build(fact_tables(t)).withColumn("score_raw", F.col("score_raw").cast("double"))


# -- joins and aggregates -------------------------------------------------------------------------------------------
@query(
    "q02_semi_restrict",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
       WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""",
)
def semi_restrict(t):
    keys = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.restrict(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), keys, ["l_orderkey"])


@query(
    "q03_inner_chain_max",
    """SELECT r_name AS learning_unit_id, max(n_name) AS activity_type, CAST(max(s_suppkey) AS BIGINT) AS activity_attempts
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def inner_chain_max(t):
    """Page - resource - activity chain, played by region - nation - supplier."""
    pages = t.region.select(F.col("r_name").alias("learning_unit_id"), F.col("r_regionkey").alias("page_id"))
    resources = t.nation.select(F.col("n_regionkey").alias("page_id"), F.col("n_nationkey").alias("resource_id"))
    activities = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_nationkey").alias("resource_id"), F.col("n_name").alias("activity_type"),
        F.col("s_suppkey").alias("activity_attempts"),
    )
    return fact.unit_activities(pages, resources, activities)


@query(
    "q04_left_fanout",
    """SELECT c_custkey, c_mktsegment, o_orderkey, o_orderpriority FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
)
def left_fanout(t):
    """Every match of a row is kept; rows without one stay."""
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    return joins.lookup(t.customer.select("c_custkey", "c_mktsegment"), orders, ["c_custkey"])


@query("q05_distinct_keys", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'")
def distinct_keys(t):
    """Distinct statement keys of one verb."""
    verbs = t.lineitem.select(
        F.col("l_orderkey").alias("lrs_id"), F.col("l_suppkey").alias("client_id"), F.col("l_orderkey").alias("statement_id"),
        F.col("l_returnflag").alias("verb_id"),
    )
    return fact.answered_keys(verbs, "A").select(F.col("lrs_id").alias("l_orderkey"), F.col("client_id").alias("l_suppkey"))


@query(
    "pushed_distinct_keys",
    """SELECT DISTINCT CAST(o_orderkey % 10 AS VARCHAR) AS lrs_id, CAST(o_orderkey % 4 AS VARCHAR) AS client_id,
       CAST(o_orderkey AS VARCHAR) AS statement_id FROM orders WHERE o_orderstatus = 'F'""",
)
def pushed_distinct(t):
    return fact.answered_keys(fact_tables(t)["dim_lrs_verb"])


@query(
    "q06_active_max",
    """SELECT c_mktsegment, max(c_name) AS session_id, true AS session_active FROM customer WHERE c_acctbal > 0
       GROUP BY c_mktsegment""",
)
def active_max(t):
    active = t.customer.where(F.col("c_acctbal") > 0)
    return reports.greatest_with_flag(active, "c_mktsegment", "c_name", "session_id", "session_active")


@query(
    "active_schools",
    """SELECT CAST(s_suppkey AS VARCHAR) AS school_id_system, max(n_name) AS session_id, true AS session_active
       FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0 GROUP BY s_suppkey""",
)
def active_schools(t):
    tables = fact_tables(t)
    return fact.active_schools(tables["dim_school"], tables["dim_school_level_session"])


@query(
    "existence_split",
    """SELECT 'update' AS kind, count(*) AS n, min(o_orderkey) AS first_key FROM orders
         WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
       UNION ALL SELECT 'insert', count(*), min(o_orderkey) FROM orders
         WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def existence_split(t):
    """Rows whose key the target has, and the others."""
    target = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    parts = zip(("update", "insert"), joins.split_existing(t.orders, target, ["o_custkey"]))
    frames = [
        df.agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key")).withColumn("kind", F.lit(kind))
        for kind, df in parts
    ]
    return frames[0].unionByName(frames[1])


@query(
    "q32_range_replay",
    """WITH notices AS (SELECT event_id AS notice_id, user_id,
           lpad(CAST(event_id AS VARCHAR), 56, '0') AS lo, lpad(CAST(event_id + 40 AS VARCHAR), 56, '0') AS hi
         FROM events WHERE event_type = 'error')
       SELECT n.notice_id, e.event_id, e.user_id, e.event_type FROM notices n JOIN events e ON e.user_id = n.user_id
         AND lpad(CAST(e.event_id AS VARCHAR), 56, '0') BETWEEN n.lo AND n.hi""",
)
def range_replay(t):
    """All records of a shard between the first and last sequence number of each expired batch."""
    number = lambda c: F.lpad(c.cast("string"), 56, "0")
    log = t.events.select(
        F.col("user_id").cast("string").alias("shard_id"), number(F.col("event_id")).alias("sequence_number"),
        "event_id", "event_type",
    )
    notices = t.events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("notice_id"),
        F.col("user_id").cast("string").alias("shard_id"),
        number(F.col("event_id")).alias("start_sequence"),
        number(F.col("event_id") + 40).alias("end_sequence"),
    )
    found = joins.replay(log, notices)
    return found.select("notice_id", "event_id", F.col("shard_id").cast("long").alias("user_id"), "event_type")


@query(
    "replay_notices",
    f"""SELECT event_id, 'shard-' || user_id AS shard FROM events WHERE event_type = 'error' AND {K_SQL} % 3 <> 0""",
)
def replay_notices(t):
    """Only complete notices of batches that expired by age are replayed."""
    from learnlake.operators.routing import replayable
    from learnlake.schemas.events import DLQ_BODY

    k = F.get_json_object("props", "$.k").cast("int")
    info = F.struct(
        s("shard-", ".user_id").alias("shardId"),
        F.col("event_id").cast("string").alias("startSequenceNumber"),
        F.when(k % 3 != 0, F.col("event_id").cast("string")).alias("endSequenceNumber"),
        F.lit(25).alias("batchSize"),
        F.lit("arn").alias("streamArn"),
    )
    condition = F.when(F.col("event_type") == "error", "RecordAgeExceeded").otherwise("RetryAttemptsExhausted")
    body = F.to_json(F.struct(F.struct(condition.alias("condition")).alias("requestContext"), info.alias("KinesisBatchInfo")))
    notices = t.events.select("event_id", F.from_json(body, DLQ_BODY).alias("n")).select("event_id", "n.*")
    return replayable(notices).select("event_id", F.col("KinesisBatchInfo.shardId").alias("shard"))


# -- scalars --------------------------------------------------------------------------------------------------------
@query(
    "q07_padded_uuid",
    """SELECT c_custkey, '00000000-0000-1000-0000-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS id,
       '00000000-0000-1000-0000-' || lpad(c_name, 12, '0') AS cut FROM customer""",
)
def padded_uuid(t):
    return t.customer.select(
        "c_custkey", ids.padded_uuid(F.col("c_custkey")).alias("id"), ids.padded_uuid(F.col("c_name")).alias("cut")
    )


@query(
    "q08_sentinel_null",
    """SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS objective,
       CASE WHEN p_size % 7 <> 0 AND p_size % 3 <> 0 THEN CAST(p_size AS DOUBLE) END AS score FROM part""",
)
def sentinel_null(t):
    size = F.col("p_size")
    objective = F.when(size % 5 == 0, "-1").otherwise(size.cast("string"))
    raw = F.when(size % 7 == 0, "None").when(size % 3 == 0, "n/a").otherwise(size.cast("string"))
    return t.part.select(
        "p_partkey", ids.sentinel_to_null(objective).alias("objective"), ids.score(raw).cast("double").alias("score")
    )


@query(
    "q09_when_default",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 'image' ELSE o_orderstatus END AS response,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus ELSE 'img' END AS text_response,
       coalesce(CASE WHEN o_orderstatus = 'F' THEN true END, false) AS done,
       o_orderpriority = '1-URGENT' AS is_image FROM orders""",
)
def when_default(t):
    extensions = F.when(F.col("o_orderpriority") == "1-URGENT", SCORM)
    kind = F.when(F.col("o_orderpriority") == "2-HIGH", "other").otherwise(F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey",
        fact.shown_response(kind, F.col("o_orderstatus")).alias("response"),
        fact.text_response(extensions, F.col("o_orderstatus"), F.lit("img")).alias("text_response"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", True), F.lit(False)).alias("done"),
        text.is_image(F.when(F.col("o_orderpriority") == "1-URGENT", "data:image/png").otherwise("x")).alias("is_image"),
    )


@query(
    "q19_byte_truncate",
    """WITH cut AS (SELECT doc_id, text, CASE WHEN octet_length(encode(text)) <= 256 THEN text ELSE
         left(text, list_max(list_filter(range(0, 257), lambda n: octet_length(encode(left(text, n))) <= 256))) END AS cut
       FROM documents)
       SELECT doc_id, cut, CAST(octet_length(encode(cut)) AS INTEGER) AS bytes FROM cut""",
)
def byte_truncate(t):
    cut = t.documents.select("doc_id", text.truncate_bytes(F.col("text")).alias("cut"))
    return cut.withColumn("bytes", F.octet_length("cut"))


@query(
    "q20_chunk_text",
    """SELECT doc_id, CAST(n AS INTEGER) AS chunk_no, substr(text, n * 5000 + 1, 5000) AS chunk,
         CAST(length(substr(text, n * 5000 + 1, 5000)) AS INTEGER) AS size
       FROM (SELECT doc_id, text, unnest(range(0, greatest(length(text) - 1, 0) // 5000 + 1)) AS n FROM documents)""",
)
def chunk_text(t):
    rows = t.documents.select("doc_id", F.posexplode(text.chunks(F.col("text"), 5000)).alias("chunk_no", "chunk"))
    return rows.withColumn("size", F.char_length("chunk"))


@query(
    "q24_concat_name",
    """SELECT c_custkey,
         trim(CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE n_name || ' ' END || c_mktsegment || CASE WHEN n_nationkey % 2 = 0
           THEN '' ELSE ' ' || c_name END) AS full_name,
         trim(CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE n_name END || ', ' || r_name || ', ' ||
           CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE c_name END, ', ') AS full_address,
         replace(lower(c_mktsegment || ' ' || r_name), ' ', '_') AS folder
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def concat_name(t):
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    first = F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).otherwise("")
    last = F.when(F.col("n_nationkey") % 2 != 0, F.col("c_name"))
    return df.select(
        "c_custkey",
        text.full_name(first, F.col("c_mktsegment"), last).alias("full_name"),
        text.full_address(first, F.col("r_name"), last).alias("full_address"),
        text.folder_name(s(".c_mktsegment", " ", ".r_name")).alias("folder"),
    )


# -- lists ----------------------------------------------------------------------------------------------------------
TURNS = "struct<turn:bigint,role:string,text:string>"


def _users(t) -> DataFrame:
    """Events with a list of zero to three users."""
    k = F.get_json_object("props", "$.k").cast("int")
    users = F.transform(
        F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(s("u", (F.col("user_id") + i).cast("string")).alias("person"), i.alias("i"))
    )
    return t.events.select("event_id", k.alias("k"), F.filter(users, lambda u: u["i"] < k % 4).alias("users"))


@query(
    "q21_first_element",
    f"SELECT event_id, CASE WHEN {K_SQL} % 4 > 0 THEN 'u' || user_id END AS person FROM events",
)
def first_element(t):
    return _users(t).select("event_id", shaping.first_item(F.col("users"))["person"].alias("person"))


@query(
    "q22_explode_outer",
    f"""SELECT event_id, CASE WHEN i < {K_SQL} % 4 THEN 'u' || (user_id + i) END AS person FROM events, range(0, 3) AS r(i)
        WHERE i < {K_SQL} % 4 OR ({K_SQL} % 4 = 0 AND i = 0)""",
)
def explode_outer(t):
    """One row per user; an empty list leaves one row without a user."""
    return _users(t).select("event_id", F.explode_outer("users").alias("u")).select("event_id", F.col("u.person").alias("person"))


@query(
    "q23_first_with_key",
    """WITH first_turn AS (SELECT conv_id, arg_min(text, turn) AS system_text FROM conversations WHERE role = 'system'
         GROUP BY conv_id)
       SELECT conv_id, turn, role, system_text FROM conversations LEFT JOIN first_turn USING (conv_id)""",
)
def first_with_key(t):
    """The first system turn of a conversation beside every turn; a map-side combined aggregate, not a collected list."""
    turns = t.conversations
    first = turns.where(F.col("role") == "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("system_text"))
    return joins.lookup(turns.select("conv_id", "turn", "role"), first, ["conv_id"])


# -- incremental ----------------------------------------------------------------------------------------------------
@query(
    "q17_incremental_window",
    """SELECT event_id, ts FROM events WHERE ts > (SELECT min(ts) FROM events)
       AND ts <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""",
)
def incremental_window(t):
    """Half-open window between two marks: the first row's time is out, the upper mark is in."""
    marks = t.events.agg(F.min("ts").alias("lo"), (F.max("ts") - F.expr("INTERVAL 1 DAY")).alias("hi")).first()
    low, high = (F.lit(marks[m]).cast("timestamp_ntz") for m in ("lo", "hi"))
    return incremental.window(t.events, "ts", low, high).select("event_id", "ts")


@query(
    "q18_high_water",
    """SELECT event_type, coalesce(max(ts), TIMESTAMP '2000-01-01') AS last_processed FROM events GROUP BY event_type
       UNION ALL SELECT 'empty', coalesce(max(ts), TIMESTAMP '2000-01-01') FROM events WHERE event_type = 'none'""",
)
def high_water(t):
    marks = t.events.groupBy("event_type").agg(incremental.high_water(F.col("ts")).alias("last_processed"))
    empty = t.events.where(F.col("event_type") == "none").agg(incremental.high_water(F.col("ts")).alias("last_processed"))
    return marks.unionByName(empty.select(F.lit("empty").alias("event_type"), "last_processed"))


@query(
    "q39_run_summary",
    """WITH r AS (SELECT 'customer' AS table_name, count(*) AS n, 'ok' AS status FROM customer
         UNION ALL SELECT 'orders', count(*), 'ok' FROM orders UNION ALL SELECT 'events', count(*), 'ok' FROM events
         UNION ALL SELECT 'lineitem', count(*), 'failed' FROM lineitem)
       SELECT * FROM r UNION ALL SELECT 'TOTAL', CAST(sum(n) FILTER (status = 'ok') AS BIGINT), 'failed' FROM r""",
)
def run_summary(t):
    tables = {name: getattr(t, name) for name in ("customer", "orders", "events", "lineitem")}
    results = incremental.table_counts(tables).withColumn(
        "status", F.when(F.col("table_name") == "lineitem", "failed").otherwise("ok")
    )
    return incremental.run_summary(results)


@query(
    "resume_listing",
    """SELECT CAST(o_orderkey AS VARCHAR) AS path FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def resume_listing(t):
    """Inputs listed but not recorded as processed."""
    listed = t.orders.select(F.col("o_orderkey").cast("string").alias("path"))
    return incremental.unprocessed(listed, t.lineitem.select(F.col("l_orderkey").cast("string").alias("path")))


# -- shaping --------------------------------------------------------------------------------------------------------
@query(
    "q34_schema_conform",
    """SELECT 'sys' || o_custkey AS id_system, o_orderpriority AS lrs_id, NULL::VARCHAR AS client_id,
         CAST(o_orderkey AS VARCHAR) AS statement_id, CAST(NULL AS VARCHAR) AS success_status,
         o_orderstatus AS response FROM orders WHERE o_orderkey <> 7""",
)
def schema_conform(t):
    """Rename, cast, fill and filter; the excluded id is a parameter here."""
    df = t.orders.select(
        s("sys", ".o_custkey").alias("id_sys"), F.col("o_orderpriority").alias("lrs_id"),
        F.col("o_orderkey").alias("id_statement"), F.col("o_orderstatus").alias("response"),
    )
    shaped = shaping.reshape(df, history.RESULT_NAMES, gold.schema("gold.dim_lrs_result"), history.SHORT_IDS, ["7"])
    return shaped.select("id_system", "lrs_id", "client_id", "statement_id", "success_status", "response")


@query(
    "conform_to_table",
    """SELECT CAST(c_custkey AS VARCHAR) AS session_id, c_mktsegment AS company_id, NULL::VARCHAR AS session_code,
         NULL::VARCHAR AS session_description, NULL::VARCHAR AS session_paying_status, c_name AS session_active FROM customer""",
)
def conform_to_table(t):
    """Unknown columns are dropped, missing ones are NULL, order follows the table."""
    df = t.customer.select(
        F.col("c_name").alias("session_active"), F.col("c_custkey").alias("session_id"),
        F.col("c_mktsegment").alias("company_id"), F.col("c_acctbal").alias("not_in_table"),
    )
    return shaping.conform(df, "gold.dim_session").drop("dt_load")


def _history(t) -> tuple[DataFrame, DataFrame]:
    """Order lines as old results (with exact duplicates), orders as objects."""
    lines = t.lineitem
    results = lines.select(
        s("sys", ".l_partkey").alias("id_sys"),
        F.lit("lrs1").alias("lrs_id"),
        F.when(F.col("l_linenumber") == 1, F.rpad(s("ç", ".l_suppkey"), 300, "ñ")).otherwise(s("ç", ".l_suppkey")).alias("client_id"),
        F.col("l_orderkey").cast("string").alias("id_statement"),
        F.when(F.col("l_returnflag") == "A", "true").when(F.col("l_returnflag") == "R", "maybe").otherwise("false").alias("success"),
        F.col("l_linestatus").alias("response"),
        s("PT", ".l_linenumber", "S").alias("duration"),
        F.lit(None).cast("string").alias("score_scaled"),
        F.col("l_linenumber").cast("string").alias("score_raw"),
        F.lit("0").alias("score_min"),
        F.lit("10").alias("score_max"),
        (F.col("l_linestatus") == "O").alias("completion"),
        s("pat", ".l_linenumber").alias("scorm&46_correctResponsesPattern"),
        s("resp", ".l_partkey").alias("scorm&46_response"),
        F.lit("rec").alias("scorm&46_multipleRecording"),
        F.lit(None).cast("string").alias("scorm&46_image"),
    )
    objects = t.orders.where(F.col("o_orderstatus") != "O").select(
        F.col("o_orderkey").cast("string").alias("id_statement"), F.col("o_orderpriority").alias("interactionType")
    )
    return results.unionAll(results), objects.unionAll(objects)


HISTORY_SQL = """(SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem)"""
CLIENT_SQL = """CASE WHEN l_linenumber = 1 THEN left('ç' || l_suppkey || repeat('ñ', 300), 1 +
    length(CAST(l_suppkey AS VARCHAR)) + (254 - length(CAST(l_suppkey AS VARCHAR))) // 2) ELSE 'ç' || l_suppkey END"""


@query(
    "q35_rename_join",
    f"""SELECT DISTINCT 'sys' || l_partkey AS id_system, 'lrs1' AS lrs_id, {CLIENT_SQL} AS client_id,
         CAST(l_orderkey AS VARCHAR) AS statement_id, CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN NULL ELSE false END
         AS success_status, l_linestatus AS response, 'PT' || l_linenumber || 'S' AS duration, NULL::VARCHAR AS score_scaled,
         CAST(l_linenumber AS VARCHAR) AS score_raw, '0' AS score_min, '10' AS score_max, l_linestatus = 'O' AS completion,
         o_orderpriority AS interaction_type, NULL::VARCHAR AS extensions
        FROM {HISTORY_SQL} JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'O'""",
)
def history_result(t):
    return history.convert(*_history(t))["dim_lrs_result"].drop("dt_load")


@query(
    "history_result_scorm",
    f"""SELECT id_system, lrs_id, client_id, statement_id, correct_responses_pattern, response, multiple_recording, image
        FROM (SELECT DISTINCT 'sys' || l_partkey AS id_system, 'lrs1' AS lrs_id, {CLIENT_SQL} AS client_id,
          CAST(l_orderkey AS VARCHAR) AS statement_id, 'pat' || l_linenumber AS correct_responses_pattern,
          'resp' || l_partkey AS response, 'rec' AS multiple_recording, NULL::VARCHAR AS image, l_returnflag, l_linestatus
        FROM lineitem)""",
)
def history_scorm(t):
    return history.convert(*_history(t))["dim_lrs_result_scorm"].drop("dt_load")


# -- changes --------------------------------------------------------------------------------------------------------
@query(
    "q25_upsert",
    """WITH ch AS (SELECT c_custkey + 50 AS c_custkey, c_name, c_acctbal + 1000 AS c_acctbal FROM customer),
         t AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer)
       SELECT coalesce(t.c_custkey, ch.c_custkey) AS c_custkey, coalesce(ch.c_name, t.c_name) AS c_name, t.c_mktsegment,
         CASE WHEN ch.c_custkey IS NOT NULL THEN ch.c_acctbal ELSE t.c_acctbal END AS c_acctbal
       FROM t FULL JOIN ch ON t.c_custkey = ch.c_custkey""",
)
def upsert(t):
    """Shifted customers: most keys exist, the highest are new; the unmapped column survives on existing rows."""
    target = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    rows = t.customer.select(
        (F.col("c_custkey") + 50).alias("c_custkey"), "c_name", (F.col("c_acctbal") + 1000).alias("c_acctbal")
    )
    return changes.upsert(target, rows, ["c_custkey"])


@query(
    "upsert_repeated_keys",
    """WITH t AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM orders),
         ch AS (SELECT c_custkey AS o_custkey, c_mktsegment AS o_orderpriority FROM customer)
       SELECT coalesce(t.o_custkey, ch.o_custkey) AS o_custkey, t.o_orderkey, t.o_orderstatus,
         coalesce(ch.o_orderpriority, t.o_orderpriority) AS o_orderpriority
       FROM t FULL JOIN ch ON t.o_custkey = ch.o_custkey""",
)
def upsert_repeated(t):
    """Every row of a repeated key is updated; a key without rows gets one."""
    target = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    rows = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("o_orderpriority"))
    return changes.upsert(target, rows, ["o_custkey"])


@query(
    "q26_delete",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def delete(t):
    gone = t.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return changes.delete(t.orders.select("o_orderkey", "o_custkey"), gone, ["o_custkey"])


@query(
    "delete_counts",
    """SELECT count(*) FILTER (o_custkey IS NOT NULL AND o_custkey IN (SELECT c_custkey FROM customer)) AS deleted,
         count(*) FILTER (o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer)) AS skipped
       FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey * 2 END AS o_custkey FROM orders)""",
)
def delete_counts(t):
    """Requests with an absent or NULL key are skipped and counted."""
    requests = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") * 2).alias("c_custkey"))
    return changes.delete_counts(t.customer, requests, ["c_custkey"])


@query(
    "q27_apply_latest",
    """WITH ch AS (SELECT user_id, event_id, value, event_type, ts,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
           bool_or(event_type = 'error') OVER (PARTITION BY user_id) AS reset FROM events),
         last AS (SELECT * FROM ch WHERE rn = 1),
         t AS (SELECT c_custkey AS user_id, c_mktsegment AS segment, c_acctbal AS value FROM customer)
       SELECT t.user_id, t.segment, CASE WHEN l.user_id IS NULL THEN t.value ELSE l.value END AS value
         FROM t LEFT JOIN last l ON t.user_id = l.user_id WHERE l.user_id IS NULL OR NOT l.reset
       UNION ALL SELECT l.user_id, NULL, l.value FROM last l WHERE l.event_type <> 'error'
         AND (l.reset OR l.user_id NOT IN (SELECT user_id FROM t))""",
)
def apply_latest(t):
    """Many changes per key in one batch; errors play deletes."""
    target = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("value"))
    batch = t.events.select(
        "user_id", "value", "ts", "event_id", F.when(F.col("event_type") == "error", "deleted").otherwise("updated").alias("op")
    )
    return changes.apply_changes(target, batch, ["user_id"], ["user_id", "value"], ["ts", "event_id"])


@query(
    "q28_item_delete",
    """WITH grown AS (SELECT o_custkey AS id, o_orderstatus AS note FROM orders
         UNION ALL SELECT user_id, event_type FROM events WHERE event_type <> 'error')
       SELECT id, note FROM grown WHERE id NOT IN (SELECT user_id FROM events WHERE event_type = 'error')""",
)
def item_delete(t):
    """Appends first, then deletes by id."""
    target = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("note"))
    rows = t.events.select(
        F.col("user_id").alias("id"), F.col("event_type").alias("note"),
        F.when(F.col("event_type") == "error", "delete").otherwise(F.col("event_type")).alias("action"),
    )
    return changes.append_then_delete(target, rows)


# -- reports --------------------------------------------------------------------------------------------------------
@query(
    "q29_success_rate",
    """SELECT user_id % 4 AS shard, count(*) AS total, count(*) FILTER (event_type <> 'error') AS ok,
         count(*) FILTER (event_type = 'error') AS failed,
         count(*) FILTER (event_type <> 'error') * 100.0::DOUBLE / count(*) AS success_rate FROM events GROUP BY 1""",
)
def success_rate(t):
    sharded = t.events.select((F.col("user_id") % 4).alias("shard"), "event_type")
    return reports.success_counts(sharded, F.col("event_type") != "error", ["shard"])


@query(
    "q30_latency_stats",
    """SELECT o_orderpriority, avg(d) AS avg_ms, min(d) AS min_ms, max(d) AS max_ms, count(d) AS samples FROM
         (SELECT o_orderpriority, CAST((epoch(l_shipdate) - epoch(o_orderdate)) * 1000 AS BIGINT) AS d
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""",
)
def latency_stats(t):
    """Time from order to shipment as publish-to-arrival latency."""
    df = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    millis = (F.unix_micros(F.col("l_shipdate").cast("timestamp")) - F.unix_micros(F.col("o_orderdate").cast("timestamp"))) / 1000
    return reports.latency(df, millis.cast("long"), ["o_orderpriority"])


@query(
    "throughput",
    """SELECT event_type, count(*) AS n, CAST(epoch(max(ts)) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT) AS elapsed_s,
         count(*) / (CAST(epoch(max(ts)) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT))::DOUBLE AS per_second
       FROM (SELECT event_type, date_trunc('second', ts) AS ts FROM events) GROUP BY 1""",
)
def throughput(t):
    return reports.throughput(t.events, F.unix_seconds(F.col("ts").cast("timestamp")), ["event_type"])


@query(
    "q31_target_vs_actual",
    """WITH x AS (SELECT user_id % 4 AS t, event_id % 5 AS a, event_type <> 'error' AS ok FROM events),
         m AS (SELECT t AS shard, count(*) AS target FROM x GROUP BY 1),
         r AS (SELECT a AS shard, count(*) AS actual FROM x WHERE ok GROUP BY 1)
       SELECT coalesce(m.shard, r.shard) AS shard, coalesce(target, 0) AS target, coalesce(actual, 0) AS actual,
         CASE WHEN coalesce(target, 0) > 0 THEN coalesce(actual, 0) * 100.0::DOUBLE / target END AS match_rate
       FROM m FULL JOIN r ON m.shard = r.shard""",
)
def target_vs_actual(t):
    return reports.target_vs_actual(t.events, F.col("user_id") % 4, F.col("event_id") % 5, F.col("event_type") != "error")


@query("q33_file_top1", "SELECT source AS path, count(*) AS records FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def file_top1(t):
    return largest(t.documents.groupBy(F.col("source").alias("path")).agg(F.count("*").alias("records")))


@query(
    "preview_rows",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5",
)
def preview_rows(t):
    return reports.preview(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], 5)


@query(
    "load_distinct_rows",
    "SELECT DISTINCT event_type, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def distinct_rows(t):
    """Files with exact duplicates loaded without them."""
    from learnlake.session import scratch_path
    from learnlake.sources.files import load_distinct

    path = scratch_path(t.spark, "duplicates")
    t.events.select("event_type", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k")).write.parquet(path)
    return load_distinct(t.spark, path)


@query(
    "bucket_union",
    "SELECT o_orderkey, CAST(o_custkey % 50 AS INTEGER) AS bucket FROM orders",
)
def bucket_union(t):
    """Union of both halves of a split load, with bucket numbers from the id."""
    rows = t.orders.select("o_orderkey", F.pmod("o_custkey", F.lit(50)).cast("int").alias("bucket"), "o_orderstatus")
    from learnlake.sources.files import union_all

    kinds = [r[0] for r in rows.select("o_orderstatus").distinct().collect()]  # the few statuses there are
    parts = [rows.where(F.col("o_orderstatus").eqNullSafe(F.lit(v))) for v in kinds]
    return union_all(parts).drop("o_orderstatus")


@query(
    "q41_late_split",
    """WITH m AS (SELECT max(ts) AS now FROM events)
       SELECT event_id, 'late' AS side FROM events, m WHERE ts < now - INTERVAL 300 SECOND
       UNION ALL SELECT event_id, 'on time' FROM events, m WHERE NOT (ts < now - INTERVAL 300 SECOND)""",
)
def late_split(t):
    """Records older than the age limit leave the stream."""
    from learnlake.streaming.jobs import split_late

    now = t.events.agg(F.max("ts").alias("now")).first()["now"]
    on_time, late = split_late(t.events, F.col("ts"), F.lit(now).cast("timestamp_ntz"))
    side = lambda df, name: df.select("event_id", F.lit(name).alias("side"))
    return side(on_time, "on time").unionByName(side(late, "late"))
