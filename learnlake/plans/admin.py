"""School-administration events: one projection per entity and target table.

Input frames carry the event as VARIANT column ``doc`` (``{meta, data: {attributes}}``). Paths below start at the
attributes. List targets keep one row per parent: the first list element, or NULLs carrying the parent id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.paths import at, at_or, present, project
from learnlake.functions.text import full_address, full_name
from learnlake.operators.shaping import conform

DOC = "doc"
ROOT = "data.attributes"


def entity(doc: str = DOC) -> Column:
    return at(doc, "meta.entityKey")


def action(doc: str = DOC) -> Column:
    return at(doc, "meta.action")


def _ref(*names: str) -> dict[str, str]:
    """``column=path`` pairs given as ``"school_id unoSchool"``: each reads the reference id under the path."""
    return {column: f"{path}.refId" for column, path in (n.split() for n in names)}


def _own(path: str) -> str:
    return f"{ROOT}.{path}"


# Entity -> target -> column -> path below the attributes ("../x" starts at the data block, "/x" at the event)
FLAT: dict[str, tuple[str, dict[str, str]]] = {
    "SCHOOLCLASS": (
        "gold.dim_school_class",
        {"school_class_id": "refId", "order_number": "order", "school_class_name": "name"}
        | _ref(
            "school_info_id unoSchool", "school_level_id schoolLevel", "school_grade_group_id schoolGradeGroup",
            "session_id session",
        )
        | {c: f"../{c}" for c in ("base_group_id", "score_metric", "library", "forum", "grade_id")},
    ),
    "SCHOOLGRADEGROUP": (
        "gold.dim_school_grade_group",
        {"school_grade_group_id": "refId", "description": "alias", "group_description": "group.groupDescription"}
        | _ref(
            "school_level_id schoolLevelSession.schoolLevel", "session_id schoolLevelSession.session",
            "school_id schoolLevelSession.unoSchool", "school_level_session_id schoolLevelSession", "grade_id grade",
            "group_id group",
        )
        | {c: f"../{c}" for c in ("grade_code", "group_code", "level_code", "grade_description")},
    ),
    "SCHOOLLEVELSESSION": (
        "gold.dim_school_level_session",
        {
            "school_level_session_id": "refId", "active_status": "active", "image": "image",
            "payment_allowed": "paymentAllowed",
        }
        | _ref("session_id session", "school_id unoSchool", "school_level_id schoolLevel", "company_id empresa")
        | {c: f"../{c}" for c in ("school_level_session_code", "demo_status")},
    ),
    "SESSION": (
        "gold.dim_session",
        {
            "session_id": "refId", "session_code": "sessionCode", "session_description": "sessionDescription",
            "session_paying_status": "sessionPaying", "session_active": "sessionActive",
        }
        | _ref("company_id empresa"),
    ),
    "SUBJECTSCHOOLCLASS": (
        "gold.dim_section_subject",
        {
            "subject_grade_id": "subjectSchoolClass.subjectGradeSchoolClassRefId",
            "subject_class_id": "subjectSchoolClass.subjectSchoolClassRefId",
            "subject_id": "subjectSchoolClass.subjectRefId",
            "subject_class_name": "subjectSchoolClass.subjectSchoolClassName",
            "order_number": "subjectSchoolClass.order",
            "school_code": "/school_code",
            "score_metric": "/score_metric",
            "section_subject_weight": "/section_subject_weight",
        }
        | _ref(
            "school_class_id schoolClass", "school_id unoSchool", "school_level_id schoolLevel",
            "school_stage_season schoolStageSeason", "school_level_session_id schoolLevelSession", "session_id session",
        ),
    ),
    "UNOSCHOOL": (
        "gold.dim_school",
        {
            "school_id": "refId", "school_id_system": "schoolIdSystem", "name": "name", "corporate_id": "corporate_id",
            "corporate_name": "corporate_name", "active_status": "active", "demo_status": "demo",
        }
        | _ref("country_id country"),
    ),
    "USERROLE": (
        "gold.dim_user_role",
        {
            "user_role_id": "refId", "status_role": "active", "user_login": "user_login",
            "status_user_login": "status_user_login",
        }
        | _ref(
            "student_id unoStudent", "role_id role", "school_level_id schoolLevelSession.schoolLevel",
            "company_id unoStudent.schoolGradeGroup.unoSchool", "grade_id unoStudent.schoolGradeGroup.grade",
            "group_id unoStudent.schoolGradeGroup.group", "school_grade_group_id unoStudent.schoolGradeGroup",
        ),
    ),
}

# parent ids repeated on every row of a user list
USER_LISTS: dict[str, tuple[str, dict[str, str], dict[str, str]]] = {
    "USERGROUP": (
        "gold.dim_user_group",
        _ref(
            "group_id group", "grade_id grade", "school_id unoSchool", "school_level_id schoolLevel",
            "school_stage_season_id schoolStageSeason", "school_level_session_id schoolLevelSession",
            "session_id session",
        ),
        {"person_id": "personRefId", "role_id": "roleRefId", "person_rol_id": "personRolRefId", "active_status": "active"},
    ),
    "USERSCHOOLCLASS": (
        "gold.dim_class_participant",
        _ref(
            "section_id schoolClass", "school_id unoSchool", "school_level_id schoolLevel",
            "school_stage_season_id schoolStageSeason", "session_id session",
        )
        | {"dt_year": "/dt_year"},
        {"user_id": "personRefId", "role_id": "roleRefId", "person_role_id": "personRolRefId", "active_status": "active"},
    ),
}


Projection = Callable[..., DataFrame]


def _rows(events: DataFrame, columns: dict, table: str, carry: Sequence[str]) -> DataFrame:
    """Project and conform; ``carry`` columns of the input stay on every row."""
    return conform(events.select(*project(DOC, columns), *carry), table, extra=carry)


def _absolute(path: str) -> str:
    if path.startswith("/"):
        return path[1:]
    return f"data.{path[3:]}" if path.startswith("../") else _own(path)


def _flat(name: str, extra: dict[str, Column] | None = None) -> Projection:
    table, mapping = FLAT[name]

    def build(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        columns = {c: at(DOC, _absolute(p)) for c, p in mapping.items()} | (extra or {})
        return _rows(events.where(entity() == name), columns, table, carry)

    return build


def _user_list(name: str) -> Projection:
    """One row per listed user, in list order; carried rows also keep that order as ``item_no``."""
    table, parent, item = USER_LISTS[name]

    def build(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        rows = events.where(entity() == name).select(
            *project(DOC, {c: _absolute(p) for c, p in parent.items()}),
            *carry,
            F.posexplode_outer(at(DOC, _own("userList"), "array<variant>")).alias("item_no", "item"),
        )
        extra = [*carry, "item_no"] if carry else []
        return conform(rows.select(*parent, *project("item", item), *extra), table, extra=extra)

    return build


def _user_role(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Ids that appear in two places take the documented one first."""
    session = _own("schoolLevelSession")
    extra = {
        "person_id": F.coalesce(at(DOC, _own("person.refId")), at(DOC, _own("unoStudent.person.refId"))),
        "school_id": at(DOC, f"{session}.unoSchool.refId"),
        "school_level_sessions_id": at(DOC, f"{session}.refId"),
    }
    return _flat("USERROLE", extra)(events, carry)


def _section_subject(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    extra = {
        "school_class_id": F.coalesce(
            at(DOC, _own("schoolClass.refId")), at(DOC, _own("schoolClass.school_class_id"))
        )
    }
    return _flat("SUBJECTSCHOOLCLASS", extra)(events, carry)


# -- users and schools: a main row plus first-of-list rows ----------------------------------------------------------
def _user(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    first, middle, last = (at_or(DOC, _own(f"name.{n}"), "") for n in ("firstName", "middleName", "lastName"))
    columns = {
        "user_id": at(DOC, _own("refId")),
        "country_id": at(DOC, _own("country.refId")),
        "language_code": at(DOC, _own("language.refId")),
        "full_name": full_name(first, middle, last),
        "first_name": first,
        "second_name": middle,
        "last_name": last,
        "birth_date": at(DOC, _own("birthDate")),
        "gender": at(DOC, _own("sex")),
        "fiscal_id": at(DOC, _own("fiscal_id")),
        "oficial_id": at(DOC, _own("oficialId")),
        "uno_user_name": F.coalesce(at(DOC, _own("user.username")), at(DOC, _own("uno_user_name"))),
        "active_status": F.coalesce(at(DOC, _own("user.active")), at(DOC, _own("active_status"))),
    }
    return _rows(events.where(entity() == "USER"), columns, "gold.dim_user", carry)


def _phone(name: str, table: str, key: str) -> Projection:
    phone = _own("phoneNumberList[0].phoneNumber")
    columns = {key: _own("refId"), "phone_number": f"{phone}.number", "phone_type": f"{phone}.phoneNumberType"}
    return lambda events, carry=(): _rows(events.where(entity() == name), columns, table, carry)


def _school_email(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    columns = {"school_email_id": _own("refId"), "email": _own("schoolEmailList[0].schoolEmail.email")}
    return _rows(events.where(entity() == "UNOSCHOOL"), columns, "gold.dim_school_email", carry)


def _user_email(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The person list if it has elements, else the user list; either item key may hold the address."""
    item = F.coalesce(*[at(DOC, _own(f"{kind}EmailList[0]"), "variant") for kind in ("person", "user")])
    rows = events.where(entity() == "USER").select(at(DOC, _own("refId")).alias("user_email_id"), item.alias("item"), *carry)
    email = F.when(present("item", "personEmail"), at("item", "personEmail.email")).otherwise(
        at("item", "userEmail.email")
    )
    return conform(rows.select("user_email_id", email.alias("email"), *carry), "gold.dim_user_email", extra=carry)


def _address(name: str, table: str, key: str, with_postal: bool, extra: dict[str, str]) -> Projection:
    """Missing text parts of an existing address are empty; without any address all parts are NULL."""
    item, address = _own("addressList[0]"), _own("addressList[0].address")

    def build(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        listed = present(DOC, item)
        text = lambda part: F.when(listed, at_or(DOC, f"{address}.{part}", ""))
        street, area, city = text("street.line1"), text("neighborhood"), text("city")
        postal = text("postalCode") if with_postal else at(DOC, f"{address}.postalCode")
        parts = [street, area, city] + ([postal] if with_postal else [])
        columns = {
            key: at(DOC, _own("refId")),
            "full_address": F.when(listed, full_address(*parts)),
            "building_site_number": at(DOC, f"{address}.buildingSiteNumber"),
            "neighborhood": area,
            "city": city,
            "postal_code": postal,
            "address_type": at(DOC, f"{address}.addressType"),
        } | {c: at(DOC, _own(p)) for c, p in extra.items()}
        return _rows(events.where(entity() == name), columns, table, carry)

    return build


TARGETS: dict[str, Projection] = {
    "gold.dim_school_class": _flat("SCHOOLCLASS"),
    "gold.dim_school_grade_group": _flat("SCHOOLGRADEGROUP"),
    "gold.dim_school_level_session": _flat("SCHOOLLEVELSESSION"),
    "gold.dim_session": _flat("SESSION"),
    "gold.dim_section_subject": _section_subject,
    "gold.dim_school": _flat("UNOSCHOOL"),
    "gold.dim_school_address": _address("UNOSCHOOL", "gold.dim_school_address", "school_address_id", True, {}),
    "gold.dim_school_phone": _phone("UNOSCHOOL", "gold.dim_school_phone", "school_phone_id"),
    "gold.dim_school_email": _school_email,
    "gold.dim_user": _user,
    "gold.dim_user_phone": _phone("USER", "gold.dim_user_phone", "user_phone_id"),
    "gold.dim_user_email": _user_email,
    "gold.dim_user_address": _address(
        "USER", "gold.dim_user_address", "user_address_id", False, {"country_id": "country.refId"}
    ),
    "gold.dim_user_group": _user_list("USERGROUP"),
    "gold.dim_user_role": _user_role,
    "gold.dim_class_participant": _user_list("USERSCHOOLCLASS"),
}


# entity -> its target tables
ENTITY_TABLES = {name: [table] for name, (table, *_) in (FLAT | USER_LISTS).items()}
ENTITY_TABLES["UNOSCHOOL"] += ["gold.dim_school_address", "gold.dim_school_phone", "gold.dim_school_email"]
ENTITY_TABLES["USER"] = ["gold.dim_user", "gold.dim_user_phone", "gold.dim_user_email", "gold.dim_user_address"]
