"""Batch refresh of nine learning dimensions from a raw table ``(event VARIANT, dt_load)`` with normalized keys.

Each dimension is one select over one incremental window of the raw table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from learnlake.functions.keys import normal_name
from learnlake.functions.paths import not_null, project
from learnlake.operators.incremental import last_loaded, progress, run_summary, save_progress, window
from learnlake.parallel import attempt, each
from learnlake.schemas.events import ACT_TYPE, SCORM
from learnlake.session import written
from learnlake.sinks.tables import register

EVENT = "event"
LAG = "INTERVAL 15 MINUTES"  # from a raw row's load time to when its file can be read, at most
ACT_BLOCK = f"statement.object.definition.extensions.`{normal_name(ACT_TYPE)}`"
SCORM_BLOCK = f"statement.result.extensions.`{normal_name(SCORM)}`"

# Target columns and the event paths they are read from.
KEYS = {"statement_id": "id", "lrs_id": "lrsid", "client_id": "clientid"}

DIMENSIONS: dict[str, dict] = {
    "dim_lrs_actor": KEYS | {
        "actor_name": "statement.actor.name",
        "actor_mbox": "statement.actor.mbox",
        "actor_type": "statement.actor.objecttype",
    },
    "dim_lrs_object": KEYS | {
        "object_id": "statement.object.id",
        "object_type": "statement.object.objecttype",
        "interaction_type": "statement.object.definition.interactiontype",
        "definition_description_es": "statement.object.definition.description.es",
    },
    "dim_lrs_object_http": KEYS | {
        column: f"{ACT_BLOCK}.{name}"
        for column, name in {
            "activity_id": "activityrefid",
            "resource_ref_id": "resourceid",
            "resource_id": "resourcerefid",
            "source_id": "sourcerefid",
            "learning_unit_id": "learningunitrefid",
            "section_subject_id": "sectionsubjectrefid",
            "school_class_id": "schoolclassid",
            "learning_objective_id": "learningobjectiverefid",
            "type_intelligence": "typeactivityintelligence",
            "page_ref": "pagerefid",
            "student_id": "studentrefid",
            "role_id": "rolid",
            "level_code": "levelcode",
            "learning_level_id": "learninglevelrefid",
            "adventure_code": "adventurecode",
            "activity_type": "typeactivityvalue",
            "act_type": "acttype",
            "unit_id": "unitid",
            "learning_objective_id_api": "learningobjectiverefidapi",
            "subject_grade_id": "subjectgraderefid",
            "school_id": "schoolrefid",
        }.items()
    },
    "dim_lrs_result": KEYS | {
        "score_raw": "statement.result.score.raw",
        "score_max": "statement.result.score.max",
        "score_min": "statement.result.score.min",
        "response": "statement.result.response",
        "success_status": ("statement.result.success", "boolean"),
    },
    "dim_lrs_statement": KEYS | {
        "active_status": ("active", "boolean"),
        "related_activities": "relatedactivities[0]",
        "date_stored": "statement.stored",
    },
    "dim_lrs_verb": KEYS | {
        "verb_id": "statement.verb.id",
        "display_und": "statement.verb.display.und",
        "display_en_us": "statement.verb.display.enus",
        "display_es_es": "statement.verb.display.eses",
        "display_de_de": "statement.verb.display.dede",
        "display_es": "statement.verb.display.es",
        "display_en_gb": "statement.verb.display.engb",
        "display_fr_fr": "statement.verb.display.frfr",
    },
    "dim_lrs_authority": KEYS | {
        "authority_name": "statement.authority.name",
        "authority_mbox": "statement.authority.mbox",
    },
    "dim_lrs_context": KEYS | {
        "context_parent": "statement.context.contextactivities.parent[0].id",
        "context_parent_object_type": "statement.context.contextactivities.parent[0].objecttype",
    },
    "dim_lrs_result_scorm": KEYS | {
        "multiple_recording": f"{SCORM_BLOCK}.multiplerecording",
        "correct_responses_pattern": f"{SCORM_BLOCK}.correctresponsespattern",
        "response": f"{SCORM_BLOCK}.response",
    },
}


def dimension(raw: DataFrame, name: str, low=None, high=None) -> DataFrame:
    """Rows of one dimension for raw rows with ``low < dt_load <= high`` (either bound may be None)."""
    rows = window(raw, "dt_load", low, high)
    if name == "dim_lrs_object_http":
        rows = rows.where(not_null(EVENT, ACT_BLOCK))
    return rows.select(*project(EVENT, DIMENSIONS[name]), "dt_load")


# Column names of the stand-alone selects where they differ from the tables'.
STAND_ALONE = {
    "dim_lrs_object_http": {"page_ref": "page_ref_id"},
    "dim_lrs_result_scorm": {"multiple_recording": "recording", "correct_responses_pattern": "pattern_response"},
}


def stand_alone(raw: DataFrame, name: str) -> DataFrame:
    """All rows of one dimension under the names of the stand-alone selects, every column as text, without load time."""
    rows = dimension(raw, name).drop("dt_load")
    names = STAND_ALONE.get(name, {})
    return rows.select(*[F.col(c).cast("string").alias(names.get(c, c)) for c in rows.columns])


def flat(rows: DataFrame) -> DataFrame:
    """Every value that the dimensions take from an event, each path once, beside ``dt_load``: see ``flat_dimension``."""
    return rows.select(*project(EVENT, {c: (p, t) for (p, t), c in _FLAT.items()}), not_null(EVENT, ACT_BLOCK).alias("has_act"), "dt_load")


def flat_dimension(rows: DataFrame, name: str, low=None, high=None) -> DataFrame:
    """``dimension`` of the raw rows that ``flat`` was made of."""
    rows = window(rows, "dt_load", low, high)
    if name == "dim_lrs_object_http":
        rows = rows.where("has_act")
    return rows.select(*[F.col(_FLAT[_typed(source)]).alias(column) for column, source in DIMENSIONS[name].items()], "dt_load")


def _typed(source: str | tuple[str, str]) -> tuple[str, str]:
    return source if isinstance(source, tuple) else (source, "string")


_FLAT = {
    source: f"c{i}" for i, source in enumerate(dict.fromkeys(_typed(s) for columns in DIMENSIONS.values() for s in columns.values()))
}


def _load(spark: SparkSession, flattened: DataFrame, name: str, table: str, base: str, low, upto) -> tuple:
    """Append the rows after the table's mark; their count and greatest load time are observed while writing."""
    rows = flat_dimension(flattened, name, low, upto)
    if not spark.catalog.tableExists(table):
        register(spark, table, f"{base}/{table}", rows.schema)
    counted = Observation()
    rows.observe(counted, F.count(F.lit(1)).alias("n"), F.max("dt_load").alias("last")).write.mode("append").insertInto(table)
    return counted.get["n"], counted.get["last"]


def marks(spark: SparkSession, database: str, control: str) -> dict:
    """Where each dimension's next window begins: the mark saved with its last load, or the newest row if a load came
    after that mark but was not recorded. Only rows beyond the mark are looked at."""
    saved = {}
    if spark.catalog.tableExists(control):
        saved = {r["table_name"]: r["last_processed"] for r in progress(spark, control).collect()}  # one row a table
    return {name: last_loaded(spark, f"{database}.{name}", after=saved.get(name)) for name in DIMENSIONS}


def window_rows(raw: DataFrame, low, upto) -> DataFrame:
    """The raw rows after ``low`` up to ``upto``; a raw table in load days is read for those days only."""
    rows = window(raw, "dt_load", low, upto)
    if "load_date" in raw.columns:
        rows = rows.where((F.col("load_date") >= F.to_date(low)) & (F.col("load_date") <= F.to_date(upto)))
    return rows


def refresh(spark: SparkSession, raw: DataFrame, database: str, base: str, upto) -> DataFrame:
    """Bring all nine dimensions up to ``upto``: ``(table_name, n, status)`` per table and in total.

    The window after the oldest mark is read once: the values of all tables are taken from an event together and kept in
    columns in the shared folder, of which each table reads its own. Tables load independently; one that
    fails is reported and picks up from its own mark next time. A table's mark is the greatest load time it really
    received, not ``upto``: raw rows get their load time before their files appear, and files that appear later are read
    next time. For the same reason rows younger than ``LAG`` wait for the next refresh; no raw write may take longer.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    control = f"{database}.load_progress"
    low = marks(spark, database, control)
    upto = F.least((upto if isinstance(upto, Column) else F.lit(upto)).cast("timestamp"), F.current_timestamp() - F.expr(LAG))
    rows = written(flat(window_rows(raw, F.lit(min(low.values())), upto)), "window")
    counts: dict[str, tuple] = {}

    def run(name: str) -> tuple[str, str | None]:
        table = f"{database}.{name}"
        return attempt(lambda: counts.update({name: _load(spark, rows, name, table, base, F.lit(low[name]), upto)}), lambda: None)

    status = each({name: (lambda n=name: run(n)) for name in DIMENSIONS})
    loaded = {name: counts[name][1] or low[name] for name, (state, _) in status.items() if state == "ok"}
    if loaded:
        save_progress(spark, control, base, loaded)
    table = [(name, counts.get(name, (0,))[0], state) for name, (state, _) in status.items()]
    return run_summary(spark.createDataFrame(table, "table_name string, n long, status string"))
