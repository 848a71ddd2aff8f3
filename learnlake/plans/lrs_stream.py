"""Learning-record stream: one select per target table, from decoded events in their original key spelling.

Input frames carry the event as VARIANT column ``doc``. Each target reads only the paths it needs; the verbs that
feed it are a filter, so one pass per target covers all verbs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.paths import at, not_null, present, project
from learnlake.functions.text import chunks, joined_list
from learnlake.operators.routing import stream_route, verb_id_only
from learnlake.operators.shaping import conform
from learnlake.schemas.events import ACT_TYPE, IDS, SCORM, VERB_PREFIX

DOC = "doc"
RESPONSE_CHUNK = 64_000
EXTENSIONS = "statement.object.definition.extensions"
SCORM_BLOCK = f"statement.result.extensions.`{SCORM}`"

# Target columns and the event paths they are read from.
KEYS = {"id_system": "id", "lrs_id": "lrs_id", "client_id": "client_id", "statement_id": "statement.id"}

STATEMENT = KEYS | {
    "date_insert": "date_insert",
    "active_status": "active",
    "verb_id": "verbID",
    "activity_id": "activityID",
    "date_stored": "statement.stored",
    "voided_status": "voided",
    "dt_time": "statement.timestamp",
}

VERB = KEYS | {"verb_id": "statement.verb.id", "display_und": "statement.verb.display.und"}

# object_http column <- name inside the extension block
OBJECT_BLOCK = {
    "resource_ref_id": "resourceRefId",
    "resource_id": "resourceId",
    "student_id": "studentRefId",
    "role_id": "rolId",
    "adventure_code": "adventureCode",
    "source_id": "sourceRefId",
    "learning_unit_id": "learningUnitRefId",
    "section_subject_id": "sectionSubjectRefId",
    "school_class_id": "schoolClassId",
    "subject_grade_id": "subjectGradeRefId",
    "school_id": "schoolRefId",
}

RESULT = KEYS | {
    "success_status": "statement.result.completion",
    "duration": "statement.result.duration",
    "score_scaled": "statement.result.score.scaled",
    "score_raw": "statement.result.score.raw",
    "score_min": "statement.result.score.min",
    "score_max": "statement.result.score.max",
    "completion": "statement.result.completion",
    "interaction_type": "statement.object.definition.interactionType",
}

RESULT_SCORM = KEYS | {
    "correct_responses_pattern": f"{SCORM_BLOCK}.correctResponsesPattern",
    "response": f"{SCORM_BLOCK}.response",
    "multiple_recording": f"{SCORM_BLOCK}.multipleRecording",
}


def _verb_is(*names: str) -> Column:
    return verb_id_only(DOC).isin([VERB_PREFIX + n for n in names])


def _has_rows() -> Column:
    """Answered and terminated always project; experienced only with its id block."""
    return _verb_is("answered", "terminated") | (_verb_is("experienced") & present(DOC, f"{EXTENSIONS}.`{IDS}`"))


def statement(events: DataFrame) -> DataFrame:
    lists = {"related_agents": joined_list(DOC, "relatedAgents"), "related_activities": joined_list(DOC, "relatedActivities")}
    return conform(events.where(_has_rows()).select(*project(DOC, STATEMENT | lists)), "gold.dim_lrs_statement")


def verb(events: DataFrame) -> DataFrame:
    return conform(events.where(_has_rows()).select(*project(DOC, VERB)), "gold.dim_lrs_verb")


def object_http(events: DataFrame) -> DataFrame:
    """The block is the activity block for answered events and the id block for the others."""
    answered = _verb_is("answered")
    block = {
        column: F.when(answered, at(DOC, f"{EXTENSIONS}.`{ACT_TYPE}`.{name}")).otherwise(
            at(DOC, f"{EXTENSIONS}.`{IDS}`.{name}")
        )
        for column, name in OBJECT_BLOCK.items()
    }
    rows = events.where(_has_rows()).select(*project(DOC, KEYS | {"object_id": "statement.object.id"} | block))
    return conform(rows, "gold.dim_lrs_object_http")


def result(events: DataFrame) -> DataFrame:
    rows = events.where(_verb_is("terminated") & not_null(DOC, "statement.result"))
    rows = rows.select(*project(DOC, RESULT | {"extensions": F.lit(SCORM)}))
    return conform(rows, "gold.dim_lrs_result")


def result_scorm(events: DataFrame, chunk: int = RESPONSE_CHUNK) -> DataFrame:
    """Answers to open and matching questions; a long open answer spans several rows, numbered by ``chunk_no``."""
    kind = at(DOC, "statement.object.definition.interactionType")
    rows = events.where(_verb_is("answered") & kind.isin("long-fill-in", "matching")).select(
        *project(DOC, RESULT_SCORM), kind.alias("kind")
    )
    pieces = F.when(F.col("kind") == "long-fill-in", chunks(F.col("response"), chunk)).otherwise(F.array("response"))
    rows = rows.select("*", F.posexplode_outer(pieces).alias("chunk_no", "piece")).withColumn("response", F.col("piece"))
    return conform(rows, "gold.dim_lrs_result_scorm", extra=["chunk_no"])


TARGETS = {
    "gold.dim_lrs_statement": statement,
    "gold.dim_lrs_verb": verb,
    "gold.dim_lrs_object_http": object_http,
    "gold.dim_lrs_result": result,
    "gold.dim_lrs_result_scorm": result_scorm,
}


def unknown(events: DataFrame) -> DataFrame:
    """Events whose verb has no projection."""
    return events.where(stream_route(verb_id_only(DOC)).isNull())
