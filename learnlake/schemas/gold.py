"""Target tables: column order, key columns and the columns filled at load time."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the target tables, in table order.
LRS_COMMON = "dt_load id_system lrs_id client_id statement_id"

COLUMNS: dict[str, list[str]] = {
    table: names.split()
    for table, names in {
        # learning-record stream
        "gold.dim_lrs_object_http": LRS_COMMON + """ object_id action_type_id resource_id page_id unit_id
            school_class_id student_id school_id role_id subject_grade_id section_subject_id grade_id source_id
            type_evaluation planning_id moment_code unit_code group_id resource_ref_id activity_id learning_unit_id
            learning_objective_id page_ref type_intelligence level_code learning_level_id adventure_code
            activity_type act_type learning_objective_id_api achievement_code""",
        "gold.dim_lrs_result": LRS_COMMON + """ success_status response duration score_scaled score_raw score_min
            score_max completion interaction_type extensions""",
        "gold.dim_lrs_result_scorm": LRS_COMMON + """ correct_responses_pattern response multiple_recording image""",
        "gold.dim_lrs_verb": LRS_COMMON + """ verb_id display_de_de display_en_us display_fr_fr display_es_es
            display_und display_es""",
        "gold.dim_lrs_statement": LRS_COMMON + """ date_insert active_status verb_id activity_id related_agents
            related_activities date_stored voided_status dt_time""",
        # school administration
        "gold.dim_school_class": """dt_load school_class_id school_info_id base_group_id order_number school_level_id
            score_metric library forum grade_id school_class_name school_grade_group_id session_id""",
        "gold.dim_school_grade_group": """dt_load school_level_id session_id school_id school_level_session_id grade_id
            group_id group_description description school_grade_group_id grade_code group_code level_code
            grade_description""",
        "gold.dim_school_level_session": """dt_load school_level_session_id school_level_session_code session_id
            school_id school_level_id company_id active_status demo_status image payment_allowed""",
        "gold.dim_session": """dt_load session_id company_id session_code session_description session_paying_status
            session_active""",
        "gold.dim_section_subject": """dt_load school_class_id subject_grade_id subject_class_id school_id subject_id
            school_code subject_class_name score_metric section_subject_weight order_number school_level_id
            school_stage_season school_level_session_id session_id""",
        "gold.dim_school": """dt_load school_id country_id school_id_system name corporate_id corporate_name
            active_status demo_status""",
        "gold.dim_school_address": """dt_load full_address school_address_id building_site_number neighborhood city
            postal_code address_type""",
        "gold.dim_school_phone": "school_phone_id phone_number phone_type",
        "gold.dim_school_email": "school_email_id email",
        "gold.dim_user": """dt_load user_id country_id language_code full_name first_name second_name last_name
            birth_date gender fiscal_id oficial_id uno_user_name active_status""",
        "gold.dim_user_phone": "dt_load user_phone_id phone_number phone_type",
        "gold.dim_user_email": "dt_load user_email_id email",
        "gold.dim_user_address": """dt_load user_address_id address_type full_address city neighborhood postal_code
            building_site_number country_id""",
        "gold.dim_user_group": """dt_load group_id grade_id school_id school_level_id school_stage_season_id
            school_level_session_id session_id person_id role_id person_rol_id active_status""",
        "gold.dim_user_role": """dt_load user_role_id student_id user_login role_id status_role school_level_id
            school_id company_id school_level_sessions_id grade_id group_id school_grade_group_id status_user_login
            person_id""",
        "gold.dim_class_participant": """dt_load user_id role_id section_id person_role_id active_status dt_year
            school_id school_level_id school_stage_season_id session_id""",
        # reading plan
        "stream.lql": """completed_sessions total_sessions cached_progress title status updated_at book_serie
            book_teacher_path_id resume book_pack_ids book_isbn author_surname author_name initiative_code code
            library isbn info_target info_referrer info_origin info_school_id info_product_id info_user_id
            info_user_cookie_session_id finished_at description_event action_event type_event book_pack_name
            book_pack_id product_id group_id school_level_id session_id network_id empresa_id name description type
            user_id user_agent locale ip_address school_id id role action end_date start_date stream_time_insert
            started_at""",
        # ingest log and fact
        "infrastructure.kinesis_log": """kinesis_name event_source event_version shard_id aws_region partition_key
            sequence_number s3_uri""",
        "gold.ft_student_response_activity_table": """lrs_id client_id statement_id object_id session_id
            session_active student_code student_id school_class_code school_class_id school_code school_id
            subject_grade_id page_id activity_id role_id section_subject_id learning_objective_id learning_level_id
            correct_responses_pattern score_raw success_status text_response response learning_unit_id attempts
            activity_type evaluable evaluated dt_time""",
    }.items()
}

# Columns a load leaves to the table's default.
LOAD_TIME_COLUMNS = ("dt_load", "dt_end", "stream_time_insert")

# Key columns for updates and deletes. Section subjects, user groups and class participants use a
# finer key than their parent's id, which would make rows of one parent overwrite each other; callers may pass
# their own lists.
KEYS: dict[str, list[str]] = {
    "gold.dim_school_class": ["school_class_id"],
    "gold.dim_school_grade_group": ["school_grade_group_id"],
    "gold.dim_school_level_session": ["school_level_session_id"],
    "gold.dim_session": ["session_id"],
    "gold.dim_section_subject": ["subject_class_id"],
    "gold.dim_school": ["school_id"],
    "gold.dim_school_address": ["school_address_id"],
    "gold.dim_school_phone": ["school_phone_id"],
    "gold.dim_school_email": ["school_email_id"],
    "gold.dim_user": ["user_id"],
    "gold.dim_user_phone": ["user_phone_id"],
    "gold.dim_user_address": ["user_address_id"],
    "gold.dim_user_email": ["user_email_id"],
    "gold.dim_user_group": ["group_id", "person_id"],
    "gold.dim_user_role": ["user_role_id"],
    "gold.dim_class_participant": ["user_id", "section_id"],
}

# Columns that are not text in the fact table; every other target column is a string.
FACT_TYPES: dict[str, T.DataType] = {
    "session_active": T.BooleanType(),
    "score_raw": T.FloatType(),
    "success_status": T.BooleanType(),
    "attempts": T.IntegerType(),
    "evaluable": T.IntegerType(),
    "evaluated": T.BooleanType(),
}


def column_type(table: str, column: str) -> T.DataType:
    if column in LOAD_TIME_COLUMNS:
        return T.TimestampType()
    if table == "gold.ft_student_response_activity_table":
        return FACT_TYPES.get(column, T.StringType())
    return T.StringType()


def schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(table, c)) for c in COLUMNS[table]])


def data_columns(table: str) -> list[str]:
    """The columns a projection fills, in table order."""
    return [c for c in COLUMNS[table] if c not in LOAD_TIME_COLUMNS]
