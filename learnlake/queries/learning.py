"""Learning-record queries: stream targets, batch dimensions, envelopes, routing and key normalization."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.functions.keys import normal_events, normalize, normalize_json
from learnlake.functions.paths import at, column_name
from learnlake.functions.text import strip_quotes
from learnlake.operators import routing
from learnlake.operators.shaping import spread
from learnlake.plans import lrs_batch, lrs_stream
from learnlake.queries import inputs
from learnlake.queries.inputs import ACT_NAMES, ID_NAMES, K_SQL, STAMP_SQL, VERB_SQL
from learnlake.queries.registry import query, table_sql
from learnlake.schemas.events import SCORM, VERB_PREFIX, wide_paths
from learnlake.session import written
from learnlake.sources import envelope

EVENTS_SQL = f"""(SELECT *, {K_SQL} AS k, {VERB_SQL} AS verb, {STAMP_SQL} AS stamp FROM events)"""
HAS_ROWS_SQL = "(verb IN ('answered', 'terminated') OR (verb = 'experienced' AND k % 5 <> 0))"
LRS_SQL = {
    "id_system": "'ev' || event_id",
    "lrs_id": "'lrs' || (user_id % 7)",
    "client_id": "'c' || user_id",
    "statement_id": "'st' || event_id",
}


def _decoded(t) -> DataFrame:
    return envelope.good(envelope.decode(inputs.learning_records(t)))


# -- stream targets -------------------------------------------------------------------------------------------------
@query(
    "stream_dim_lrs_statement",
    table_sql("gold.dim_lrs_statement", LRS_SQL | {
        "date_insert": "stamp",
        "active_status": "CASE WHEN value > 50 THEN 'true' ELSE 'false' END",
        "verb_id": f"'{VERB_PREFIX}' || verb",
        "activity_id": "'http://activity/' || k",
        "related_agents": "'agent''' || user_id || ',\"mbox\":\"' || k || '\"'",
        "related_activities": "CASE WHEN k % 4 <> 0 THEN 'http://activity/' || k ELSE '' END",
        "date_stored": "stamp",
        "voided_status": "'false'",
        "dt_time": "stamp",
    }, f"FROM {EVENTS_SQL} WHERE {HAS_ROWS_SQL}"),
)
def stream_statement(t):
    return lrs_stream.statement(_decoded(t)).drop("dt_load")


@query(
    "stream_dim_lrs_verb",
    table_sql("gold.dim_lrs_verb", LRS_SQL | {"verb_id": f"'{VERB_PREFIX}' || verb", "display_und": "verb"},
              f"FROM {EVENTS_SQL} WHERE {HAS_ROWS_SQL}"),
)
def stream_verb(t):
    return lrs_stream.verb(_decoded(t)).drop("dt_load")


@query(
    "stream_dim_lrs_object_http",
    table_sql("gold.dim_lrs_object_http", LRS_SQL | {"object_id": "'http://object/' || event_id"} | {
        column: f"'{name}-' || k"
        for column, name in {
            "resource_ref_id": "resourceRefId", "resource_id": "resourceId", "student_id": "studentRefId",
            "role_id": "rolId", "adventure_code": "adventureCode", "source_id": "sourceRefId",
            "learning_unit_id": "learningUnitRefId", "section_subject_id": "sectionSubjectRefId",
            "school_class_id": "schoolClassId", "subject_grade_id": "subjectGradeRefId", "school_id": "schoolRefId",
        }.items()
    }, f"FROM {EVENTS_SQL} WHERE {HAS_ROWS_SQL}"),
)
def stream_object_http(t):
    return lrs_stream.object_http(_decoded(t)).drop("dt_load")


@query(
    "stream_dim_lrs_result",
    table_sql("gold.dim_lrs_result", LRS_SQL | {
        "success_status": "CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END",
        "duration": "'PT' || k || 'S'",
        "score_raw": "CAST(k AS VARCHAR)",
        "score_min": "'0'",
        "score_max": "'100'",
        "completion": "CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END",
        "interaction_type": "CASE k % 3 WHEN 0 THEN 'matching' WHEN 1 THEN 'long-fill-in' ELSE 'choice' END",
        "extensions": f"'{SCORM}'",
    }, f"FROM {EVENTS_SQL} WHERE verb = 'terminated' AND k % 2 = 1"),
)
def stream_result(t):
    return lrs_stream.result(_decoded(t)).drop("dt_load")


@query(
    "stream_dim_lrs_result_scorm",
    table_sql("gold.dim_lrs_result_scorm", LRS_SQL | {
        "correct_responses_pattern": "CASE WHEN k % 2 = 1 THEN 'pat' || k END",
        "response": "CASE WHEN k % 2 = 1 THEN 'answer ' || event_id END",
        "multiple_recording": "CASE WHEN k % 2 = 1 THEN 'rec' || k END",
    }, f"FROM {EVENTS_SQL} WHERE verb = 'answered' AND k % 3 IN (0, 1)", {"chunk_no": "CAST(0 AS INTEGER)"}),
)
def stream_result_scorm(t):
    return lrs_stream.result_scorm(_decoded(t)).drop("dt_load")


@query(
    "stream_unknown_events",
    f"SELECT 'ev' || event_id AS id, '{VERB_PREFIX}' || verb AS verb_id FROM {EVENTS_SQL} WHERE verb = 'completed'",
)
def stream_unknown(t):
    return lrs_stream.unknown(_decoded(t)).select(at("doc", "id").alias("id"), at("doc", "verbID").alias("verb_id"))


@query(
    "stream_rows_per_target",
    f"""WITH e AS (SELECT *, {HAS_ROWS_SQL} AS has FROM {EVENTS_SQL})
    SELECT 'gold.dim_lrs_statement' AS table_name, count(*) FILTER (has) AS n FROM e
    UNION ALL SELECT 'gold.dim_lrs_verb', count(*) FILTER (has) FROM e
    UNION ALL SELECT 'gold.dim_lrs_object_http', count(*) FILTER (has) FROM e
    UNION ALL SELECT 'gold.dim_lrs_result', count(*) FILTER (verb = 'terminated' AND k % 2 = 1) FROM e
    UNION ALL SELECT 'gold.dim_lrs_result_scorm', count(*) FILTER (verb = 'answered' AND k % 3 IN (0, 1)) FROM e
    UNION ALL SELECT 'unknown', count(*) FILTER (verb = 'completed') FROM e""",
)
def rows_per_target(t):
    """Fan-out of every event to its tables, counted in one pass per table; the events are made and decoded once."""
    from learnlake.operators.incremental import table_counts

    events = written(_decoded(t).select("doc"), "decoded")
    frames = {name: build(events) for name, build in lrs_stream.TARGETS.items()} | {"unknown": lrs_stream.unknown(events)}
    return table_counts(frames)


# -- batch dimensions ----------------------------------------------------------------------------------------------
BATCH_KEYS = "'ev' || event_id AS statement_id, 'lrs' || (user_id % 7) AS lrs_id, 'c' || user_id AS client_id"
# the window: two days after the first event up to a day and a half before the last
WINDOW_SQL = """ts > (SELECT min(ts) + INTERVAL 2 DAY FROM events)
    AND ts <= (SELECT max(ts) - INTERVAL 36 HOUR FROM events)"""

BATCH_SQL = {
    "dim_lrs_actor": (
        "'user ' || user_id AS actor_name, 'mailto:u' || user_id || '@example.org' AS actor_mbox, 'Agent' AS actor_type", ""
    ),
    "dim_lrs_object": (
        "'http://object/' || event_id AS object_id, 'Activity' AS object_type, "
        "CASE k % 3 WHEN 0 THEN 'matching' WHEN 1 THEN 'long-fill-in' ELSE 'choice' END AS interaction_type, "
        "'desc ' || k AS definition_description_es", ""
    ),
    "dim_lrs_object_http": (
        ", ".join(
            f"'{name}-' || k AS {column}"
            for name, column in {
                "activityRefId": "activity_id", "resourceId": "resource_ref_id", "resourceRefId": "resource_id",
                "sourceRefId": "source_id", "learningUnitRefId": "learning_unit_id",
                "sectionSubjectRefId": "section_subject_id", "schoolClassId": "school_class_id",
                "learningObjectiveRefId": "learning_objective_id", "typeActivityIntelligence": "type_intelligence",
                "pageRefId": "page_ref", "studentRefId": "student_id", "rolId": "role_id", "levelCode": "level_code",
                "learningLevelRefId": "learning_level_id", "adventureCode": "adventure_code",
                "typeActivityValue": "activity_type", "act_type": "act_type", "unitid": "unit_id",
                "learningObjectiveRefIdAPI": "learning_objective_id_api", "subjectGradeRefId": "subject_grade_id",
                "schoolRefId": "school_id",
            }.items()
        ), "AND verb = 'answered'"
    ),
    "dim_lrs_result": (
        "CASE WHEN k % 2 = 1 THEN CAST(k AS VARCHAR) END AS score_raw, CASE WHEN k % 2 = 1 THEN '100' END AS score_max, "
        "CASE WHEN k % 2 = 1 THEN '0' END AS score_min, CASE WHEN k % 2 = 1 THEN 'resp ' || k END AS response, "
        "CASE WHEN k % 2 = 1 THEN k % 4 = 1 END AS success_status", ""
    ),
    "dim_lrs_statement": (
        "value > 50 AS active_status, CASE WHEN k % 4 <> 0 THEN 'http://activity/' || k END AS related_activities, "
        "stamp AS date_stored", ""
    ),
    "dim_lrs_verb": (
        f"'{VERB_PREFIX}' || verb AS verb_id, verb AS display_und, verb AS display_en_us, "
        "CAST(NULL AS VARCHAR) AS display_es_es, CAST(NULL AS VARCHAR) AS display_de_de, 'es-' || verb AS display_es, "
        "CAST(NULL AS VARCHAR) AS display_en_gb, CAST(NULL AS VARCHAR) AS display_fr_fr", ""
    ),
    "dim_lrs_authority": (
        "'authority ' || user_id AS authority_name, 'mailto:a' || user_id || '@example.org' AS authority_mbox", ""
    ),
    "dim_lrs_context": (
        "CASE WHEN k % 3 = 0 THEN 'http://parent/' || k END AS context_parent, "
        "CASE WHEN k % 3 = 0 THEN 'Activity' END AS context_parent_object_type", ""
    ),
    "dim_lrs_result_scorm": (
        "CASE WHEN k % 2 = 1 THEN 'rec' || k END AS multiple_recording, "
        "CASE WHEN k % 2 = 1 THEN 'pat' || k END AS correct_responses_pattern, "
        "CASE WHEN k % 2 = 1 THEN 'answer ' || event_id END AS response", ""
    ),
}


def _register_batch(name: str, columns: str, condition: str) -> None:
    sql = f"SELECT {BATCH_KEYS}, {columns}, ts AS dt_load FROM {EVENTS_SQL} WHERE {WINDOW_SQL} {condition}"

    @query(f"batch_{name}", sql)
    def build(t):
        ends = t.events.agg(
            (F.min("ts") + F.expr("INTERVAL 2 DAY")).alias("lo"), (F.max("ts") - F.expr("INTERVAL 36 HOUR")).alias("hi")
        ).first()
        low, high = (F.lit(ends[x]).cast("timestamp_ntz") for x in ("lo", "hi"))
        return lrs_batch.dimension(inputs.raw_learning(t), name, low, high)


for _name, (_columns, _condition) in BATCH_SQL.items():
    _register_batch(_name, _columns, _condition)


def _register_stand_alone(name: str, renames: dict[str, str], condition: str) -> None:
    columns = BATCH_SQL[name][0]
    for old, new in renames.items():
        columns = columns.replace(f" AS {old}", f" AS {new}")
    inner = f"SELECT {BATCH_KEYS}, {columns} FROM {EVENTS_SQL} WHERE {condition}"

    @query(f"stand_alone_{name}", f"SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({inner})")
    def build(t):
        raw = inputs.raw_learning(t)
        answered = routing.raw_table(routing.verb_normalized("event")) == "lrs_events_answered"
        return lrs_batch.stand_alone(raw.where(answered) if name == "dim_lrs_result_scorm" else raw, name)


for _name, _condition in {
    "dim_lrs_object_http": "verb = 'answered'", "dim_lrs_result_scorm": "verb = 'answered'", "dim_lrs_statement": "true",
}.items():
    _register_stand_alone(_name, lrs_batch.STAND_ALONE.get(_name, {}), _condition)


@query(
    "wide_event_row",
    "SELECT 'ev' || event_id AS id, " + ", ".join(
        f"{e} AS {c}" for c, e in {
            "active": "CASE WHEN value > 50 THEN 'true' ELSE 'false' END",
            "verbID": f"'{VERB_PREFIX}' || verb",
            "statement_actor_mbox": "'mailto:u' || user_id || '@example.org'",
            "statement_verb_display_en_US": "verb",
            "statement_result_score_raw": "CASE WHEN k % 2 = 1 THEN CAST(k AS VARCHAR) END",
            "statement_object_definition_description_es": "'desc ' || k",
            "statement_object_definition_extensions_http_act_type_act_type":
                "CASE WHEN verb = 'answered' THEN 'act_type-' || k END",
            "statement_object_definition_extensions_http_ids_rolId":
                "CASE WHEN verb = 'terminated' OR (verb = 'experienced' AND k % 5 <> 0) THEN 'rolId-' || k END",
            "statement_context_contextActivities_parent_0_id": "CASE WHEN k % 3 = 0 THEN 'http://parent/' || k END",
            "filled": "1 * (CASE WHEN k % 4 <> 0 THEN 1 ELSE 0 END) + (CASE WHEN k % 2 = 1 THEN 11 ELSE 0 END) + "
                      f"(CASE WHEN verb = 'answered' THEN {1 + len(ACT_NAMES)} WHEN verb = 'terminated' OR "
                      f"(verb = 'experienced' AND k % 5 <> 0) THEN {1 + len(ID_NAMES)} ELSE 0 END) + "
                      "(CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 3 ELSE 0 END) + 30",
        }.items()
    ) + f" FROM {EVENTS_SQL}",
)
def wide_event(t):
    """All wide-row paths are read; a few are shown, the rest are counted when filled."""
    doc = _decoded(t)
    paths = wide_paths()
    wide = doc.select(*[at("doc", p).alias(column_name(p)) for p in paths])
    shown = [
        "id", "active", "verbID", "statement_actor_mbox", "statement_verb_display_en_US", "statement_result_score_raw",
        "statement_object_definition_description_es", "statement_object_definition_extensions_http_act_type_act_type",
        "statement_object_definition_extensions_http_ids_rolId", "statement_context_contextActivities_parent_0_id",
    ]
    filled = reduce(lambda a, b: a + b, [F.col(column_name(p)).isNotNull().cast("int") for p in paths])
    return wide.select(*shown, filled.alias("filled"))


# -- envelopes ------------------------------------------------------------------------------------------------------
@query(
    "q10_json_path",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
    "json_extract_string(props, '$.missing') AS missing FROM events",
)
def json_path_query(t):
    doc = t.events.select("event_id", F.try_parse_json("props").alias("doc"))
    return doc.select("event_id", at("doc", "k", "int").alias("k"), at("doc", "missing").alias("missing"))


@query(
    "q11_envelope_decode",
    f"""SELECT event_id, CASE WHEN event_type = 'error' AND {K_SQL} % 2 = 0 THEN NULL
          WHEN event_type = 'error' THEN 'plain ' || event_id ELSE props END AS payload,
        CASE WHEN event_type = 'error' AND {K_SQL} % 2 = 0 THEN 'not base64 text'
          WHEN event_type = 'error' THEN 'not JSON' END AS error,
        CASE WHEN event_type <> 'error' THEN {K_SQL} END AS k FROM events""",
)
def envelope_decode(t):
    """Good records, records that are not base64, and base64 that is not JSON."""
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.when(F.col("event_type") == "error", inputs.s("plain ", ".event_id")).otherwise(F.col("props"))
    data = F.when((F.col("event_type") == "error") & (k % 2 == 0), F.lit("%%% not base64")).otherwise(
        F.base64(F.encode(text, "UTF-8"))
    )
    decoded = envelope.decode(t.events.select("event_id", data.alias("data")))
    return decoded.select("event_id", "payload", "error", at("doc", "k", "int").alias("k"))


@query(
    "envelope_nested_records",
    f"""SELECT 'shardId-00000000000' || (user_id % 4) || ':4965' || lpad(CAST(event_id AS VARCHAR), 52, '0') AS "eventID",
        CAST(user_id AS VARCHAR) AS "partitionKey", 'ev' || event_id AS id FROM events""",
)
def envelope_nested(t):
    """Records nested under ``Records[].kinesis``."""
    flat = inputs.learning_records(t)
    nested = flat.select(
        F.array(
            F.struct(
                F.struct(
                    "partitionKey", F.lit("1.0").alias("kinesisSchemaVersion"), "data", "sequenceNumber",
                    "approximateArrivalTimestamp",
                ).alias("kinesis"),
                "eventSource", "eventID", "eventVersion", F.lit("aws:kinesis:record").alias("eventName"),
                F.lit("arn").alias("eventSourceARN"), "awsRegion",
            )
        ).alias("Records")
    )
    decoded = envelope.good(envelope.decode(envelope.unnest(nested)))
    return decoded.select("eventID", "partitionKey", at("doc", "id").alias("id"))


@query(
    "envelope_queue_messages",
    f"""SELECT CASE WHEN {K_SQL} % 2 = 0 THEN 'm' || event_id ELSE 'unknown' END AS "messageId",
        CASE WHEN event_type <> 'signup' THEN {K_SQL} END AS k,
        CASE WHEN event_type = 'signup' THEN 'no data' END AS error FROM events""",
)
def envelope_queue(t):
    """Queue messages whose body is JSON text holding the data; some bodies are broken, some ids missing."""
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.to_json(F.struct(F.base64(F.encode("props", "UTF-8")).alias("data")))
    message = F.struct(
        F.when(k % 2 == 0, inputs.s("m", ".event_id")).alias("messageId"),
        F.lit("h").alias("receiptHandle"),
        F.when(F.col("event_type") == "signup", F.lit("{broken")).otherwise(body).alias("body"),
    )
    texts = t.events.select(F.to_json(F.struct(F.array(message).alias("Records"))).alias("text"))
    decoded = envelope.from_queue(envelope.queue_messages(texts))
    return decoded.select("messageId", at("doc", "k", "int").alias("k"), "error")


@query(
    "q12_envelope_regex",
    f"""SELECT event_id, {K_SQL} AS k FROM events
        WHERE event_type IN ('click', 'view', 'signup', 'error') OR (event_type = 'purchase' AND {K_SQL} % 2 = 0)""",
)
def envelope_free_form(t):
    """Lists, single records, nested records, broken text, and records of another source."""
    data = F.base64(F.encode("props", "UTF-8"))
    k = F.get_json_object("props", "$.k").cast("int")
    record = lambda source, d: F.struct(F.lit(source).alias("eventSource"), d.alias("data"))
    other = F.base64(F.encode(F.lit("not json"), "UTF-8"))
    text = (
        F.when(F.col("event_type") == "click", F.to_json(F.array(record("aws:kinesis", data), record("other", data))))
        .when(F.col("event_type") == "view", F.to_json(record("aws:kinesis", data)))
        .when(F.col("event_type") == "signup", F.to_json(inputs.obj(Records=F.array(inputs.obj(kinesis=inputs.obj(data=data))))))
        .when(F.col("event_type") == "error", inputs.s('broken {"data" : "', data, '", x'))
        .when(k % 2 == 0, F.to_json(record("other", data)))
        .otherwise(F.to_json(record("aws:kinesis", other)))
    )
    rows = envelope.free_form(spread(t.events, "event_id").select("event_id", text.alias("text")))
    return rows.select("event_id", F.get_json_object("payload", "$.k").cast("int").alias("k"))


@query(
    "q37_ingest_log",
    """SELECT 'learning' AS kinesis_name, 'aws:kinesis' AS event_source, '1.0' AS event_version,
        'shardId-00000000000' || (user_id % 4) AS shard_id, 'region-1' AS aws_region,
        CAST(user_id AS VARCHAR) AS partition_key, '4965' || lpad(CAST(event_id AS VARCHAR), 52, '0') AS sequence_number,
        'raw/' || strftime(ts, 'month=%m/day=%d/hour=%H') AS s3_uri FROM events""",
)
def ingest_log(t):
    from learnlake.sinks.archive import raw_uri
    from learnlake.streaming.jobs import arrival_time

    records = inputs.learning_records(t)
    return envelope.ingest_log(records, "learning", raw_uri("raw/", arrival_time(F.col("approximateArrivalTimestamp"))))


# -- key normalization ----------------------------------------------------------------------------------------------
MESSY_SQL = """SELECT event_id, user_id, event_type, 'agent' || user_id || 'x' AS agent,
    'v' || event_id AS later FROM events"""


def _messy(t) -> DataFrame:
    """Keys with underscores, dashes and capitals, nested, in lists, and two that normalize to the same name."""
    inner = F.struct(F.col("event_type").alias("Event-Type"), F.array(inputs.obj(Sub_Key=F.col("user_id"))).alias("My_List"))
    event = F.struct(
        F.col("event_id").alias("Event_ID"),
        inner.alias("Inner-Part"),
        F.array(inputs.s("agent'", ".user_id", '\\"x"')).alias("relatedAgents"),
        inputs.s("u", ".event_id").alias("unitId"),
        inputs.s("v", ".event_id").alias("unit_id"),
    )
    return spread(t.events, "event_id").select(event.alias("e"))


def _messy_columns(doc: str) -> list:
    return [
        at(doc, "eventid", "long").alias("event_id"),
        at(doc, "innerpart.mylist[0].subkey", "long").alias("user_id"),
        at(doc, "innerpart.eventtype").alias("event_type"),
        at(doc, "relatedagents[0]").alias("agent"),
        at(doc, "unitid").alias("later"),
    ]


@query("q13_key_normalize", MESSY_SQL)
def key_normalize(t):
    """Declared schema: native expressions."""
    df = _messy(t)
    return df.select(F.try_parse_json(F.to_json(normalize(F.col("e"), df.schema["e"].dataType))).alias("doc")).select(
        *_messy_columns("doc")
    )


@query("key_normalize_any_json", MESSY_SQL)
def key_normalize_any(t):
    """Unknown schema: JSON text through the Arrow function."""
    return _messy(t).select(F.try_parse_json(normalize_json(F.to_json("e"))).alias("doc")).select(*_messy_columns("doc"))


@query("key_normalize_in_place", MESSY_SQL)
def key_normalize_in_place(t):
    """Unknown schema: keys renamed where they stand in the text."""
    texts = _messy(t).select(F.to_json("e").alias("payload"))
    return normal_events(texts.withColumn("doc", F.try_parse_json("payload"))).select(*_messy_columns("event"))


@query(
    "q14_quote_strip",
    """SELECT conv_id, turn, replace(replace(replace(text, '''', ''), '\\"', ''), '"', '') AS text FROM conversations""",
)
def quote_strip(t):
    return t.conversations.select("conv_id", "turn", strip_quotes(F.col("text")).alias("text"))


# -- routing --------------------------------------------------------------------------------------------------------
@query(
    "q15_route_table",
    f"""SELECT event_id, verb AS event_kind, 'lrs_events_' || verb AS raw_table,
        CASE WHEN verb IN ('answered', 'experienced', 'attempted', 'terminated') THEN verb END AS route
        FROM {EVENTS_SQL}""",
)
def route_table(t):
    doc = _decoded(t)
    verb = routing.verb_raw_first("doc")
    return doc.select(
        F.substring(at("doc", "id"), 3, 20).cast("long").alias("event_id"),
        routing.event_type(verb).alias("event_kind"),
        routing.raw_table(verb).alias("raw_table"),
        routing.stream_route(verb).alias("route"),
    )


VERB_CASES = {
    # event_type -> (SQL of the verb each variant finds: raw first, normalized, object first, id only)
    "click": ("'a/' || event_id", "'a/' || event_id", "'a/' || event_id", "'a/' || event_id"),
    "view": ("'b/' || event_id", "'b/' || event_id", "NULL", "NULL"),
    "signup": ("NULL", "'c/' || event_id", "'c/' || event_id", "NULL"),
    "purchase": ("NULL", "NULL", "'d' || event_id", "NULL"),
    "error": ("NULL", "NULL", "NULL", "NULL"),
}


def _verb_case(i: int) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v[i]}" for k, v in VERB_CASES.items()) + " END"


@query(
    "verb_resolution",
    f"""SELECT event_id, {_verb_case(0)} AS raw_first, {_verb_case(1)} AS normalized, {_verb_case(2)} AS object_first,
        {_verb_case(3)} AS id_only, CASE event_type WHEN 'click' THEN CAST(event_id AS VARCHAR)
        WHEN 'view' THEN CAST(event_id AS VARCHAR) WHEN 'signup' THEN CAST(event_id AS VARCHAR) ELSE 'event' END AS kind,
        CASE event_type WHEN 'click' THEN 'lrs_events_all' WHEN 'view' THEN 'lrs_events_all' END AS raw_table FROM events""",
)
def verb_resolution(t):
    """Where each job looks for the verb: five event shapes, four rules."""
    kind = F.col("event_type")
    event = F.struct(
        "event_id",
        F.when(kind == "click", inputs.s("a/", ".event_id")).alias("verbID"),
        F.when(kind == "view", inputs.obj(verb=inputs.obj(id=inputs.s("b/", ".event_id"))))
        .when(kind == "purchase", inputs.obj(verb=F.lit(None).cast("struct<id:string>")))
        .alias("statement"),
        F.when(kind == "signup", inputs.obj(id=inputs.s("c/", ".event_id")))
        .when(kind == "purchase", inputs.obj(id=inputs.s("d", ".event_id")))
        .alias("verb"),
    )
    schema = t.events.select(event.alias("e")).schema["e"].dataType
    docs = t.events.select(event.alias("e")).select(
        F.try_parse_json(F.to_json("e")).alias("doc"), F.try_parse_json(F.to_json(normalize(F.col("e"), schema))).alias("norm")
    )
    raw, normal = routing.verb_raw_first("doc"), routing.verb_normalized("norm")
    return docs.select(
        at("doc", "event_id", "long").alias("event_id"),
        raw.alias("raw_first"),
        normal.alias("normalized"),
        routing.verb_object_first("doc").alias("object_first"),
        routing.verb_id_only("doc").alias("id_only"),
        routing.event_type(normal).alias("kind"),
        routing.raw_table(raw).alias("raw_table"),
    )


ROUTE_COUNTS_SQL = f"""SELECT CASE WHEN verb IN ('answered', 'experienced', 'attempted', 'terminated') THEN verb
    ELSE 'unknown' END AS route, count(*) AS n FROM {EVENTS_SQL} GROUP BY 1"""


@query("q16_route_counts", ROUTE_COUNTS_SQL)
def route_counts(t):
    routed = _decoded(t).select(routing.stream_route(routing.verb_id_only("doc")).alias("route"))
    return routing.route_counts(routed)


@query("normalized_name_list", "SELECT lower(replace(replace(p_name || '_' || p_brand, '_', ''), '-', '')) AS name, p_partkey FROM part")
def normalized_names(t):
    from learnlake.functions.text import normal_key

    return t.part.select(normal_key(F.concat("p_name", F.lit("_"), "p_brand")).alias("name"), "p_partkey")


