"""Event streams and dimension tables that Spark derives from the given parquet tables.

Every row of the source table becomes an event, so all work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.keys import normalize
from learnlake.operators.shaping import once, spread
from learnlake.queries.registry import Tables
from learnlake.schemas.events import ACT_TYPE, IDS, SCORM, VERB_PREFIX

# event_type -> verb; errors play a verb without a projection
VERBS = {"click": "answered", "view": "experienced", "signup": "attempted", "purchase": "terminated", "error": "completed"}
VERB_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in VERBS.items()) + " END"
K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
STAMP_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S')"

# names inside the two extension blocks; each value is "<name>-<k>"
ACT_NAMES = """activityRefId resourceId resourceRefId sourceRefId learningUnitRefId sectionSubjectRefId schoolClassId
    learningObjectiveRefId pageRefId typeActivityIntelligence studentRefId rolId levelCode learningLevelRefId
    adventureCode typeActivityValue act_type unitid learningObjectiveRefIdAPI subjectGradeRefId schoolRefId""".split()
ID_NAMES = """resourceId resourceRefId sourceRefId learningUnitRefId sectionSubjectRefId schoolClassId studentRefId rolId
    adventureCode subjectGradeRefId schoolRefId""".split()


def s(*parts) -> Column:
    """Concatenate texts and columns; text starting with ``.`` names a column."""
    return F.concat(*[F.col(p[1:]).cast("string") if isinstance(p, str) and p.startswith(".") else F.lit(p) if isinstance(p, str) else p for p in parts])


def obj(**fields: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def ref(value: Column) -> Column:
    return obj(refId=value.cast("string"))


def named(fields: dict[str, str]) -> str:
    """Spark SQL text of a struct."""
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


PARENT_SPARK = named({"id": "'http://parent/' || k", "objectType": "'Activity'"})
SCORM_SPARK = named({
    "multipleRecording": "'rec' || k", "correctResponsesPattern": "'pat' || k", "response": "'answer ' || event_id",
})
RESULT_SPARK = named({
    "success": "k % 4 = 1", "completion": "k % 3 = 0", "duration": "'PT' || k || 'S'", "response": "'resp ' || k",
    "score": named({"raw": "k", "min": "0", "max": "100"}), "extensions": named({SCORM: SCORM_SPARK}),
})
DEFINITION_SPARK = named({
    "interactionType": "CASE k % 3 WHEN 0 THEN 'matching' WHEN 1 THEN 'long-fill-in' ELSE 'choice' END",
    "description": named({"es": "'desc ' || k"}),
    "extensions": named({
        ACT_TYPE: f"IF(verb = 'answered', {named({n: f"'{n}-' || k" for n in ACT_NAMES})}, NULL)",
        IDS: "IF((verb = 'experienced' AND k % 5 <> 0) OR verb = 'terminated', "
             f"{named({n: f"'{n}-' || k" for n in ID_NAMES})}, NULL)",
    }),
})
STATEMENT_SPARK = named({
    "id": "'st' || event_id", "timestamp": "stamp", "stored": "stamp",
    "actor": named({"name": "'user ' || user_id", "mbox": "'mailto:u' || user_id || '@example.org'", "objectType": "'Agent'"}),
    "authority": named({"name": "'authority ' || user_id", "mbox": "'mailto:a' || user_id || '@example.org'"}),
    "verb": named({"id": f"'{VERB_PREFIX}' || verb", "display": named({"und": "verb", "en-US": "verb", "es": "'es-' || verb"})}),
    "context": f"CASE k % 3 WHEN 0 THEN {named({'contextActivities': named({'parent': f'array({PARENT_SPARK})'})})} "
               f"WHEN 1 THEN {named({'contextActivities': named({'parent': f'slice(array({PARENT_SPARK}), 1, 0)'})})} END",
    "result": f"IF(k % 2 = 1, {RESULT_SPARK}, NULL)",
    "object": named({"id": "'http://object/' || event_id", "objectType": "'Activity'", "definition": DEFINITION_SPARK}),
})
EVENT_SPARK = named({
    "id": "'ev' || event_id", "active": "IF(value > 50, 'true', 'false')", "voided": "'false'",
    "lrs_id": "'lrs' || (user_id % 7)", "client_id": "'c' || user_id", "date_insert": "stamp",
    "activityID": "'http://activity/' || k", "verbID": f"'{VERB_PREFIX}' || verb",
    "relatedAgents": """array("agent'" || user_id, '"mbox":"' || k || '"')""",
    "relatedActivities": "IF(k % 4 <> 0, array('http://activity/' || k), NULL)", "statement": STATEMENT_SPARK,
})


def learning_events(t: Tables) -> DataFrame:
    """``events`` as learning-record documents: struct column ``e`` beside event_id, user_id, k, ts."""
    rows = spread(t.events, "event_id").selectExpr(
        "*", "cast(get_json_object(props, '$.k') AS int) AS k", f"{VERB_SQL} AS verb", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS stamp"
    )
    return rows.selectExpr("event_id", "user_id", "event_type", "k", "ts", f"{EVENT_SPARK} AS e")


def raw_learning(t: Tables) -> DataFrame:
    """The raw table: ``(event VARIANT with normalized keys, dt_load)``."""
    events = learning_events(t)
    normal = normalize(F.col("e"), events.schema["e"].dataType)
    texts = events.select(F.to_json(normal).alias("text"), F.col("ts").alias("dt_load"))
    return once(texts, event=F.try_parse_json("text")).drop("text")


def envelopes(df: DataFrame, payload: Column, number: str, key: str, ts: str) -> DataFrame:
    """Flat stream records around JSON texts."""
    sequence = F.concat(F.lit("4965"), F.lpad(F.col(number).cast("string"), 52, "0"))
    return df.select(
        F.lit("aws:kinesis").alias("eventSource"),
        F.lit("1.0").alias("eventVersion"),
        F.concat(F.lit("shardId-00000000000"), (F.col(key) % 4).cast("string"), F.lit(":"), sequence).alias("eventID"),
        F.lit("region-1").alias("awsRegion"),
        F.col(key).cast("string").alias("partitionKey"),
        sequence.alias("sequenceNumber"),
        F.base64(F.encode(payload, "UTF-8")).alias("data"),
        (F.unix_micros(F.col(ts).cast("timestamp")) / 1_000_000).alias("approximateArrivalTimestamp"),
    )


def learning_records(t: Tables) -> DataFrame:
    return envelopes(learning_events(t), F.to_json("e"), "event_id", "user_id", "ts")


def document(df: DataFrame, event: Column, *keep: str) -> DataFrame:
    """JSON text of a struct as ``payload`` and parsed as ``doc``."""
    return once(once(df, payload=F.to_json(event)).select(*keep, "payload"), doc=F.try_parse_json("payload"))


def admin_document(df: DataFrame, entity: str, attributes: Column, *keep: str, action: Column | None = None) -> DataFrame:
    """Administration events of one entity, one per row."""
    action = F.lit(f"{entity.lower()}_created") if action is None else action
    meta = obj(action=action, entityKey=F.lit(entity), company=F.lit("c1"))
    return document(df, obj(meta=meta, data=obj(attributes=attributes)), *keep)
