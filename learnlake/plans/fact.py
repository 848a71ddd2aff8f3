"""Student response activity: the fact table built from learning and school dimensions.

Shape of the plan: the activity rows are reduced to answered statements by a semi join and de-duplicated in the
partitioning of the statement key. The two lookups (school, learning unit) are small aggregates, written once so
that their real size decides between a broadcast, which keeps that partitioning, and a salted join. Results, SCORM
results and statements join last on the statement key, so the closing ``distinct`` - whose columns include that key -
needs no further exchange. Inputs kept in buckets of that key (``keep``) are not exchanged at all. Restricting those inputs to the base keys first would change nothing: they are only
left-joined on exactly those keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.functions.ids import padded_uuid, score, sentinel_to_null
from learnlake.operators.joins import lookup, restrict
from learnlake.parallel import each
from learnlake.schemas import gold
from learnlake.schemas.events import SCORM, VERB_PREFIX
from learnlake.session import written
from learnlake.sinks.tables import BUCKETS, append_keyed, replace_if_any

KEY = ["lrs_id", "client_id", "statement_id"]
ANSWERED = VERB_PREFIX + "answered"
TABLE = "gold.ft_student_response_activity_table"

# Columns of the activity rows.
BASE = KEY + """object_id student_id school_class_id school_id subject_grade_id page_id activity_id role_id
    section_subject_id learning_objective_id learning_level_id learning_unit_id""".split()


def answered_keys(verbs: DataFrame, verb_id: str = ANSWERED) -> DataFrame:
    """Distinct statement keys of one verb."""
    return verbs.where(F.col("verb_id") == verb_id).select(*KEY).distinct()


def base_rows(object_http: DataFrame, verbs: DataFrame, verb_id: str = ANSWERED) -> DataFrame:
    """Distinct activity rows of answered statements."""
    return restrict(object_http.select(*BASE), verbs.where(F.col("verb_id") == verb_id), KEY).distinct()


def active_schools(schools: DataFrame, sessions: DataFrame) -> DataFrame:
    """Latest session of each school that has an active one, by the school's system id."""
    active = sessions.where(F.col("active_status")).select("school_id", "session_id")
    return (
        schools.select("school_id", "school_id_system")
        .join(active, "school_id")
        .groupBy("school_id_system")
        .agg(F.max("session_id").alias("session_id"), F.lit(True).alias("session_active"))
    )


def unit_activities(pages: DataFrame, resources: DataFrame, activities: DataFrame) -> DataFrame:
    """Greatest activity type and attempts of each learning unit over its pages' resources.

    A maximum of maxima: each step of the chain is reduced to one row per key before the next join.
    """
    greatest = [F.max(c).alias(c) for c in ("activity_type", "activity_attempts")]
    per_resource = activities.groupBy("resource_id").agg(*greatest)
    per_page = resources.select("page_id", "resource_id").join(per_resource, "resource_id").groupBy("page_id").agg(*greatest)
    units = pages.where(F.col("learning_unit_id").isNotNull()).select("learning_unit_id", "page_id")
    return units.join(per_page, "page_id").groupBy("learning_unit_id").agg(*greatest)


def text_response(extensions: Column, response: Column, image: Column) -> Column:
    return F.when(extensions == SCORM, response).otherwise(image)


def shown_response(interaction_type: Column, response: Column) -> Column:
    return F.when(interaction_type == "other", F.lit("image")).otherwise(response)


def build(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The 30-column fact from ``dim_lrs_{verb,object_http,result,result_scorm,statement}``, ``dim_{page,resource,
    activity,school,school_level_session}``. Runs two small jobs for the lookups."""
    base = base_rows(tables["dim_lrs_object_http"], tables["dim_lrs_verb"])
    lookups = each({
        "schools": lambda: written(active_schools(tables["dim_school"], tables["dim_school_level_session"]), "schools"),
        "units": lambda: written(unit_activities(tables["dim_page"], tables["dim_resource"], tables["dim_activity"]), "units"),
    })
    schools, units = lookups["schools"], lookups["units"]
    results = tables["dim_lrs_result"].select(
        *KEY,
        F.coalesce("success_status", F.lit(False)).alias("success_status"),
        score(F.col("score_raw")).alias("score_raw"),
        "interaction_type",
        "extensions",
        F.col("response").alias("result_response"),
    )
    scorm = tables["dim_lrs_result_scorm"].select(
        *KEY, "correct_responses_pattern", F.col("response").alias("scorm_response"), "image"
    )
    statements = tables["dim_lrs_statement"].select(*KEY, "dt_time")

    wide = lookup(base, units, ["learning_unit_id"])
    wide = lookup(wide, schools.withColumnRenamed("school_id_system", "school_id"), ["school_id"])
    wide = wide.join(results, KEY, "left").join(scorm, KEY, "left").join(statements, KEY, "left")

    computed = {
        "session_active": F.coalesce("session_active", F.lit(False)),
        "student_code": F.col("student_id"),
        "student_id": padded_uuid(F.col("student_id")),
        "school_class_code": F.col("school_class_id"),
        "school_class_id": padded_uuid(F.col("school_class_id")),
        "school_code": F.col("school_id"),
        "school_id": padded_uuid(F.col("school_id")),
        "learning_objective_id": sentinel_to_null(F.col("learning_objective_id")),
        "learning_level_id": sentinel_to_null(F.col("learning_level_id")),
        "success_status": F.coalesce("success_status", F.lit(False)),
        "text_response": text_response(F.col("extensions"), F.col("scorm_response"), F.col("image")),
        "response": shown_response(F.col("interaction_type"), F.col("result_response")),
        "attempts": F.coalesce(F.col("activity_attempts"), F.lit(0)).try_cast("int"),
        "activity_type": F.coalesce("activity_type", F.lit("")),
        "evaluable": F.lit(0),
        "evaluated": F.lit(False),
    }
    return wide.select(*[computed.get(c, F.col(c)).alias(c) for c in gold.COLUMNS[TABLE]]).distinct()


BUCKET_ROWS = 1_000_000  # of the longest input, in a bucket: one task joins them


def keep(tables: Mapping[str, DataFrame], database: str, base: str, n: int = BUCKETS) -> dict[str, DataFrame]:
    """The inputs of ``build``, the statement-keyed ones appended to catalog tables in ``n`` buckets of the statement key."""
    kept = each({
        name: partial(append_keyed, df, f"{database}.{name}", f"{base}/{database}/{name}", KEY, n)
        for name, df in tables.items() if name.startswith("dim_lrs_")
    })
    return dict(tables) | kept


def read_tables(
    spark: SparkSession, options: Mapping[str, str], schema: str = "gold", parts: int = 64
) -> dict[str, DataFrame]:
    """The ten inputs over JDBC; only the keys of answered statements leave the database for the verb table.

    Every statement-keyed table is read in ``parts`` ranges of its load time, whose ends the database is asked for.
    """
    from learnlake.sources.jdbc import read_query, read_table, time_bounds

    names = """dim_lrs_object_http dim_lrs_result dim_lrs_result_scorm dim_lrs_statement dim_activity dim_resource
        dim_page dim_school dim_school_level_session""".split()
    split = {n: time_bounds(spark, options, f"{schema}.{n}") for n in [*names, "dim_lrs_verb"] if n.startswith("dim_lrs")}
    tables = {
        name: read_table(spark, options, f"{schema}.{name}", "dt_load" if split.get(name) else None, split.get(name), parts)
        for name in names
    }
    tables["dim_lrs_verb"] = read_query(
        spark,
        options,
        f"SELECT DISTINCT lrs_id, client_id, statement_id, verb_id, dt_load FROM {schema}.dim_lrs_verb "
        f"WHERE verb_id = '{ANSWERED}'",
        "dt_load" if split["dim_lrs_verb"] else None,
        split["dim_lrs_verb"],
        parts,
    )
    return tables


def load(spark: SparkSession, tables: Mapping[str, DataFrame], table: str, base: str) -> bool:
    """Rebuild the fact and replace the table, unless the build has no rows."""
    return replace_if_any(spark, build(tables), table, base)
