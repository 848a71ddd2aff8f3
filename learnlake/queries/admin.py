"""School-administration and reading-plan queries over events built from orders, parts, suppliers and customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.operators import changes, routing
from learnlake.operators.shaping import spread
from learnlake.plans import admin, reading
from learnlake.queries.inputs import admin_document, document, envelopes, obj, ref, s
from learnlake.queries.registry import query, table_sql
from learnlake.schemas import gold
from learnlake.schemas.events import IGNORED_ENTITIES
from learnlake.sources import envelope


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _some(n: Column, make) -> Column:
    """A list of ``n`` (0 to 3) items made by ``make(i)``."""
    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(i.alias("i"), make(i).alias("v"))), lambda x: x["i"] < n)


def _items(n: Column, make) -> Column:
    return F.transform(_some(n, make), lambda x: x["v"])


# -- one entity per source table --------------------------------------------------------------------------------------
def sessions(t) -> DataFrame:
    return admin_document(spread(t.orders, "o_orderkey"), "SESSION", obj(
        refId=_text("o_orderkey"), sessionDescription=F.col("o_orderpriority"), order=F.col("o_custkey"),
        sessionCode=F.col("o_orderstatus"), sessionPaying=F.col("o_totalprice") > 100000,
        sessionActive=(F.col("o_custkey") % 2).cast("int"), empresa=ref(F.col("o_custkey")),
    ))


def school_classes(t) -> DataFrame:
    return admin_document(spread(t.part, "p_partkey"), "SCHOOLCLASS", obj(
        refId=_text("p_partkey"), name=F.col("p_name"), order=F.col("p_size"), schoolGradeGroup=ref(F.col("p_brand")),
        unoSchool=ref(F.col("p_type")), schoolLevel=F.when(F.col("p_size") > 10, ref(F.col("p_size"))),
        session=ref(F.col("p_partkey") + 1),
    ))


def grade_groups(t) -> DataFrame:
    session = obj(
        refId=s("sls", ".p_partkey"), unoSchool=ref(F.col("p_type")), session=ref(F.col("p_size")),
        schoolLevel=ref(F.col("p_brand")),
    )
    return admin_document(spread(t.part, "p_partkey"), "SCHOOLGRADEGROUP", obj(
        refId=_text("p_partkey"), alias=F.col("p_name"), schoolLevelSession=F.when(F.col("p_size") % 4 != 0, session),
        grade=ref(F.col("p_size")), group=obj(refId=s("g", ".p_partkey"), groupDescription=F.col("p_type")),
    ))


def level_sessions(t) -> DataFrame:
    return admin_document(spread(t.customer, "c_custkey"), "SCHOOLLEVELSESSION", obj(
        refId=_text("c_custkey"), unoSchool=ref(F.col("c_nationkey")), session=ref(F.col("c_mktsegment")),
        schoolLevel=ref(F.col("c_name")), empresa=ref(F.lit("e1")), active=F.col("c_acctbal") > 0,
        image=s("img", ".c_custkey"), paymentAllowed=F.col("c_acctbal") > 5000,
    ))


def subject_classes(t) -> DataFrame:
    key = s(".l_orderkey", "-", ".l_linenumber")
    return admin_document(spread(t.lineitem, "l_orderkey"), "SUBJECTSCHOOLCLASS", obj(
        subjectSchoolClass=obj(
            subjectSchoolClassRefId=key, subjectSchoolClassName=F.col("l_returnflag"),
            subjectGradeSchoolClassRefId=_text("l_partkey"), order=F.col("l_linenumber"), subjectRefId=_text("l_suppkey"),
        ),
        schoolClass=F.when(F.col("l_linenumber") > 1, ref(F.col("l_orderkey"))), unoSchool=ref(F.col("l_suppkey")),
        schoolLevel=ref(F.col("l_linestatus")), schoolStageSeason=ref(F.lit("st1")),
        schoolLevelSession=ref(F.col("l_orderkey")), session=ref(F.lit("s1")),
    ))


def schools(t) -> DataFrame:
    n = (F.col("s_suppkey") % 3).cast("int")
    address = lambda i: obj(address=obj(
        addressType=F.lit("main"), street=obj(line1=F.when(F.col("s_nationkey") % 2 == 0, s("street ", ".s_suppkey")).otherwise("")),
        city=F.when(F.col("s_nationkey") % 5 != 0, s("city ", ".s_nationkey")), neighborhood=s("area ", i.cast("string")),
        postalCode=F.when(F.col("s_nationkey") % 3 == 0, "").otherwise(_text("s_nationkey")), buildingSiteNumber=i.cast("string"),
    ))
    return admin_document(spread(t.supplier, "s_suppkey"), "UNOSCHOOL", obj(
        refId=_text("s_suppkey"), name=F.col("s_name"), schoolIdSystem=s("sys", ".s_suppkey"), demo=F.lit("no"),
        active=F.col("s_acctbal") > 0, country=ref(F.col("s_nationkey")), addressList=_items(n, address),
        phoneNumberList=_items(n, lambda i: obj(phoneNumber=obj(phoneNumberType=F.lit("work"), number=s("+", i.cast("string"), ".s_suppkey")))),
        schoolEmailList=_items(n, lambda i: obj(schoolEmail=obj(email=s("s", i.cast("string"), ".s_suppkey", "@example.org")))),
    ))


def user_attributes() -> Column:
    n = (F.col("c_custkey") % 3).cast("int")
    address = lambda i: obj(address=obj(
        addressType=F.lit("home"), street=obj(line1=s("street ", ".c_custkey")), city=F.lit(""),
        neighborhood=s("area ", i.cast("string")), postalCode=_text("c_nationkey"), buildingSiteNumber=i.cast("string"),
    ))
    email = lambda i: obj(email=s("u", i.cast("string"), ".c_custkey", "@example.org"))
    return obj(
        refId=_text("c_custkey"), country=ref(F.col("c_nationkey")), sex=F.lit("x"),
        name=obj(
            firstName=F.col("c_name"), middleName=F.when(F.col("c_nationkey") % 2 == 0, F.lit("")),
            lastName=F.when(F.col("c_nationkey") % 3 != 0, F.col("c_mktsegment")),
        ),
        birthDate=F.lit("2000-01-01"), language=ref(F.lit("es")), addressList=_items(n, address),
        phoneNumberList=_items(n, lambda i: obj(phoneNumber=obj(phoneNumberType=F.lit("cell"), number=s("+", i.cast("string"), ".c_custkey")))),
        personEmailList=_items(F.when(F.col("c_nationkey") % 2 == 0, n).otherwise(0), lambda i: obj(personEmail=email(i))),
        userEmailList=_items(F.lit(1), lambda i: obj(userEmail=obj(email=s("alt", ".c_custkey")))),
        user=F.when(F.col("c_acctbal") > 0, obj(username=s("login", ".c_custkey"), active=F.lit(1))),
        oficialId=s("of", ".c_custkey"),
    )


def users(t) -> DataFrame:
    return admin_document(spread(t.customer, "c_custkey"), "USER", user_attributes())


def _user_items() -> Column:
    return _items((F.col("o_custkey") % 4).cast("int"), lambda i: obj(
        personRefId=s("p", ".o_custkey", "-", i.cast("string")), roleRefId=F.lit("r1"),
        personRolRefId=i.cast("string"), active=F.col("o_totalprice") > 100000,
    ))


def user_groups(t) -> DataFrame:
    return admin_document(spread(t.orders, "o_orderkey"), "USERGROUP", obj(
        group=ref(F.col("o_orderkey")), grade=ref(F.col("o_orderstatus")), unoSchool=ref(F.col("o_custkey")),
        schoolLevel=ref(F.lit("l1")), schoolStageSeason=ref(F.lit("st1")), schoolLevelSession=ref(F.lit("ls1")),
        session=ref(F.col("o_orderpriority")), userList=_user_items(),
    ))


def user_roles(t) -> DataFrame:
    return admin_document(spread(t.customer, "c_custkey"), "USERROLE", obj(
        refId=_text("c_custkey"), person=F.when(F.col("c_acctbal") > 0, ref(F.col("c_name"))),
        unoStudent=F.when(F.col("c_nationkey") % 2 == 0, obj(
            refId=s("st", ".c_custkey"), person=ref(F.lit("other")),
            schoolGradeGroup=obj(refId=s("gg", ".c_custkey"), grade=ref(F.lit("g1")), group=ref(F.lit("gr1"))),
        )),
        active=F.col("c_acctbal") > 1000,
        schoolLevelSession=obj(
            refId=s("sls", ".c_custkey"), session=ref(F.lit("s1")), schoolLevel=ref(F.lit("l1")), unoSchool=ref(F.col("c_nationkey")),
        ),
        role=ref(F.col("c_mktsegment")),
    ))


def class_participants(t) -> DataFrame:
    return admin_document(spread(t.orders, "o_orderkey"), "USERSCHOOLCLASS", obj(
        schoolClass=ref(F.col("o_orderkey")), unoSchool=ref(F.col("o_custkey")), schoolLevel=ref(F.lit("l1")),
        schoolStageSeason=ref(F.lit("st1")), session=ref(F.col("o_orderpriority")), userList=_user_items(),
    ))


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'true' ELSE 'false' END"


def _str(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


LISTED = "s_suppkey % 3 > 0"
SCHOOL_STREET = "CASE WHEN s_nationkey % 2 = 0 THEN 'street ' || s_suppkey ELSE '' END"
SCHOOL_CITY = "CASE WHEN s_nationkey % 5 <> 0 THEN 'city ' || s_nationkey ELSE '' END"
SCHOOL_POSTAL = "CASE WHEN s_nationkey % 3 = 0 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END"
FIRST_NAME, LAST_NAME = "c_name", "CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment ELSE '' END"
USER_ROWS = "orders, range(0, 3) AS r(i) WHERE i < o_custkey % 4 OR (o_custkey % 4 = 0 AND i = 0)"


def _listed(expression: str) -> str:
    return f"CASE WHEN o_custkey % 4 > 0 THEN {expression} END"


USER_SQL = {
    "user_id": _str("c_custkey"), "country_id": _str("c_nationkey"), "language_code": "'es'",
    "full_name": f"trim({FIRST_NAME} || ' ' || {LAST_NAME})", "first_name": FIRST_NAME, "second_name": "''",
    "last_name": LAST_NAME, "birth_date": "'2000-01-01'", "gender": "'x'", "oficial_id": "'of' || c_custkey",
    "uno_user_name": "CASE WHEN c_acctbal > 0 THEN 'login' || c_custkey END",
    "active_status": "CASE WHEN c_acctbal > 0 THEN '1' END",
}
PARTICIPANT_SQL = {"role_id": _listed("'r1'"), "active_status": _listed(_flag("o_totalprice > 100000"))}

CASES = {
    "gold.dim_session": (sessions, {
        "session_id": _str("o_orderkey"), "company_id": _str("o_custkey"), "session_code": "o_orderstatus",
        "session_description": "o_orderpriority", "session_paying_status": _flag("o_totalprice > 100000"),
        "session_active": _str("o_custkey % 2"),
    }, "FROM orders"),
    "gold.dim_school_class": (school_classes, {
        "school_class_id": _str("p_partkey"), "school_info_id": "p_type", "order_number": _str("p_size"),
        "school_level_id": f"CASE WHEN p_size > 10 THEN {_str('p_size')} END", "school_class_name": "p_name",
        "school_grade_group_id": "p_brand", "session_id": _str("p_partkey + 1"),
    }, "FROM part"),
    "gold.dim_school_grade_group": (grade_groups, {
        "school_level_id": "CASE WHEN p_size % 4 <> 0 THEN p_brand END",
        "session_id": f"CASE WHEN p_size % 4 <> 0 THEN {_str('p_size')} END",
        "school_id": "CASE WHEN p_size % 4 <> 0 THEN p_type END",
        "school_level_session_id": "CASE WHEN p_size % 4 <> 0 THEN 'sls' || p_partkey END", "grade_id": _str("p_size"),
        "group_id": "'g' || p_partkey", "group_description": "p_type", "description": "p_name",
        "school_grade_group_id": _str("p_partkey"),
    }, "FROM part"),
    "gold.dim_school_level_session": (level_sessions, {
        "school_level_session_id": _str("c_custkey"), "session_id": "c_mktsegment", "school_id": _str("c_nationkey"),
        "school_level_id": "c_name", "company_id": "'e1'", "active_status": _flag("c_acctbal > 0"),
        "image": "'img' || c_custkey", "payment_allowed": _flag("c_acctbal > 5000"),
    }, "FROM customer"),
    "gold.dim_section_subject": (subject_classes, {
        "school_class_id": f"CASE WHEN l_linenumber > 1 THEN {_str('l_orderkey')} END", "subject_grade_id": _str("l_partkey"),
        "subject_class_id": "l_orderkey || '-' || l_linenumber", "school_id": _str("l_suppkey"), "subject_id": _str("l_suppkey"),
        "subject_class_name": "l_returnflag", "order_number": _str("l_linenumber"), "school_level_id": "l_linestatus",
        "school_stage_season": "'st1'", "school_level_session_id": _str("l_orderkey"), "session_id": "'s1'",
    }, "FROM lineitem"),
    "gold.dim_school": (schools, {
        "school_id": _str("s_suppkey"), "country_id": _str("s_nationkey"), "school_id_system": "'sys' || s_suppkey",
        "name": "s_name", "active_status": _flag("s_acctbal > 0"), "demo_status": "'no'",
    }, "FROM supplier"),
    "gold.dim_school_address": (schools, {
        "full_address": f"CASE WHEN {LISTED} THEN trim({SCHOOL_STREET} || ', area 0, ' || {SCHOOL_CITY} || ', ' || {SCHOOL_POSTAL}, ', ') END",
        "school_address_id": _str("s_suppkey"), "building_site_number": f"CASE WHEN {LISTED} THEN '0' END",
        "neighborhood": f"CASE WHEN {LISTED} THEN 'area 0' END", "city": f"CASE WHEN {LISTED} THEN {SCHOOL_CITY} END",
        "postal_code": f"CASE WHEN {LISTED} THEN {SCHOOL_POSTAL} END", "address_type": f"CASE WHEN {LISTED} THEN 'main' END",
    }, "FROM supplier"),
    "gold.dim_school_phone": (schools, {
        "school_phone_id": _str("s_suppkey"), "phone_number": f"CASE WHEN {LISTED} THEN '+0' || s_suppkey END",
        "phone_type": f"CASE WHEN {LISTED} THEN 'work' END",
    }, "FROM supplier"),
    "gold.dim_school_email": (schools, {
        "school_email_id": _str("s_suppkey"), "email": f"CASE WHEN {LISTED} THEN 's0' || s_suppkey || '@example.org' END",
    }, "FROM supplier"),
    "gold.dim_user": (users, USER_SQL, "FROM customer"),
    "gold.dim_user_phone": (users, {
        "user_phone_id": _str("c_custkey"), "phone_number": "CASE WHEN c_custkey % 3 > 0 THEN '+0' || c_custkey END",
        "phone_type": "CASE WHEN c_custkey % 3 > 0 THEN 'cell' END",
    }, "FROM customer"),
    "gold.dim_user_email": (users, {
        "user_email_id": _str("c_custkey"),
        "email": "CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 3 > 0 THEN 'u0' || c_custkey || '@example.org' "
                 "ELSE 'alt' || c_custkey END",
    }, "FROM customer"),
    "gold.dim_user_address": (users, {
        "user_address_id": _str("c_custkey"), "address_type": "CASE WHEN c_custkey % 3 > 0 THEN 'home' END",
        "full_address": "CASE WHEN c_custkey % 3 > 0 THEN 'street ' || c_custkey || ', area 0' END",
        "city": "CASE WHEN c_custkey % 3 > 0 THEN '' END", "neighborhood": "CASE WHEN c_custkey % 3 > 0 THEN 'area 0' END",
        "postal_code": f"CASE WHEN c_custkey % 3 > 0 THEN {_str('c_nationkey')} END",
        "building_site_number": "CASE WHEN c_custkey % 3 > 0 THEN '0' END", "country_id": _str("c_nationkey"),
    }, "FROM customer"),
    "gold.dim_user_group": (user_groups, PARTICIPANT_SQL | {
        "group_id": _str("o_orderkey"), "grade_id": "o_orderstatus", "school_id": _str("o_custkey"), "school_level_id": "'l1'",
        "school_stage_season_id": "'st1'", "school_level_session_id": "'ls1'", "session_id": "o_orderpriority",
        "person_id": _listed("'p' || o_custkey || '-' || i"), "person_rol_id": _listed(_str("i")),
    }, f"FROM {USER_ROWS}"),
    "gold.dim_user_role": (user_roles, {
        "user_role_id": _str("c_custkey"), "student_id": "CASE WHEN c_nationkey % 2 = 0 THEN 'st' || c_custkey END",
        "role_id": "c_mktsegment", "status_role": _flag("c_acctbal > 1000"), "school_level_id": "'l1'",
        "school_id": _str("c_nationkey"), "school_level_sessions_id": "'sls' || c_custkey",
        "grade_id": "CASE WHEN c_nationkey % 2 = 0 THEN 'g1' END", "group_id": "CASE WHEN c_nationkey % 2 = 0 THEN 'gr1' END",
        "school_grade_group_id": "CASE WHEN c_nationkey % 2 = 0 THEN 'gg' || c_custkey END",
        "person_id": "CASE WHEN c_acctbal > 0 THEN c_name WHEN c_nationkey % 2 = 0 THEN 'other' END",
    }, "FROM customer"),
    "gold.dim_class_participant": (class_participants, PARTICIPANT_SQL | {
        "user_id": _listed("'p' || o_custkey || '-' || i"), "section_id": _str("o_orderkey"),
        "person_role_id": _listed(_str("i")), "school_id": _str("o_custkey"), "school_level_id": "'l1'",
        "school_stage_season_id": "'st1'", "session_id": "o_orderpriority",
    }, f"FROM {USER_ROWS}"),
}


def _register(table: str, source, values: dict[str, str], tail: str) -> None:
    @query(f"admin_{table.split('.')[1]}", table_sql(table, values, tail))
    def build(t):
        return admin.TARGETS[table](source(t)).select(*gold.data_columns(table))


for _table, (_source, _values, _tail) in CASES.items():
    _register(_table, _source, _values, _tail)


# -- routing and changes ----------------------------------------------------------------------------------------------
ENTITY_CYCLE = ("USER", "SESSION", "ARTICLE", "", "SOMETHING", "UNOSCHOOL", "USERIMAGE")
ACTION_CYCLE = ("user_Created", "user_UPDATED", "user_deleted", "other", "created_then_updated")
ENTITY_SQL = "CASE event_id % 7 " + " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(ENTITY_CYCLE)) + " END"
ACTION_SQL = "CASE event_type " + " ".join(
    f"WHEN '{e}' THEN '{a}'" for e, a in zip(("click", "view", "signup", "purchase", "error"), ACTION_CYCLE)
) + " END"


@query(
    "admin_routing",
    f"""WITH e AS (SELECT event_id, {ENTITY_SQL} AS entity, {ACTION_SQL} AS action FROM events)
        SELECT event_id, CASE WHEN entity IN ('USER', 'SESSION', 'UNOSCHOOL') THEN entity END AS route,
          CASE WHEN contains(lower(action), 'created') THEN 'created' WHEN contains(lower(action), 'updated') THEN 'updated'
            WHEN contains(lower(action), 'deleted') THEN 'deleted' END AS kind,
          NOT contains(lower(action), 'updated') AND NOT contains(lower(action), 'deleted') AS created_job,
          contains(lower(action), 'updated') AND NOT contains(lower(action), 'created')
            OR contains(lower(action), 'deleted') AS change_job,
          entity <> '' AND entity NOT IN ({", ".join(repr(e) for e in IGNORED_ENTITIES)}) AS projected FROM e""",
)
def admin_routing(t):
    entities = F.array(*[F.lit(e) for e in ENTITY_CYCLE])
    actions = F.create_map(*[F.lit(x) for p in zip(("click", "view", "signup", "purchase", "error"), ACTION_CYCLE) for x in p])
    event = obj(meta=obj(
        entityKey=F.get(entities, (F.col("event_id") % 7).cast("int")), action=actions[F.col("event_type")]
    ))
    docs = document(spread(t.events, "event_id"), event, "event_id")
    return docs.select(
        "event_id",
        routing.entity_route(admin.entity()).alias("route"),
        routing.change_kind(admin.action()).alias("kind"),
        routing.is_created_job(admin.action()).alias("created_job"),
        routing.is_change_job(admin.action()).alias("change_job"),
        routing.has_projected_entity(admin.entity()).alias("projected"),
    )


@query(
    "change_stream_dim_user",
    f"""WITH ch AS (SELECT c.*, o_orderkey, o_orderstatus, o_orderpriority,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn,
             bool_or(o_orderstatus = 'F') OVER (PARTITION BY o_custkey) AS reset
           FROM orders JOIN customer c ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'),
         last AS (SELECT * FROM ch WHERE rn = 1)
       SELECT {_str('c_custkey')} AS user_id, c_name AS first_name, {LAST_NAME} AS last_name, 'old' AS fiscal_id,
         'seed' AS gender FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
       UNION ALL SELECT {_str('c_custkey')}, o_orderpriority, {LAST_NAME}, 'old', 'x' FROM last
         WHERE o_orderstatus = 'O' AND NOT reset
       UNION ALL SELECT {_str('c_custkey')}, o_orderpriority, {LAST_NAME}, NULL, 'x' FROM last
         WHERE o_orderstatus = 'O' AND reset""",
)
def change_stream(t):
    """Envelopes -> decode -> guards -> user projection -> last change per key -> updates and deletes on the user table.

    Orders play the changes (F deletes, O updates, P is a creation the change job ignores).
    """
    action = F.when(F.col("o_orderstatus") == "F", "user_deleted").when(F.col("o_orderstatus") == "O", "user_updated").otherwise("user_created")
    joined = spread(t.orders, "o_orderkey").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    attributes = user_attributes().withField("name.firstName", F.col("o_orderpriority"))
    events = admin_document(joined, "USER", attributes, "o_orderkey", "c_custkey", "o_orderdate", action=action)
    records = envelopes(events, F.col("payload"), "o_orderkey", "c_custkey", "o_orderdate")
    decoded = envelope.good(envelope.decode(records))
    admitted = decoded.where(routing.is_change_job(admin.action()) & routing.has_projected_entity(admin.entity()))
    carried = admitted.withColumns({
        "op": routing.change_kind(admin.action()), "arrival": F.col("approximateArrivalTimestamp"), "seq": F.col("sequenceNumber"),
    })
    rows = admin.TARGETS["gold.dim_user"](carried, ["op", "arrival", "seq"])
    table = "gold.dim_user"
    mapped = [c for c in gold.data_columns(table) if c != "fiscal_id"]
    target = admin.TARGETS[table](users(t)).withColumns({"fiscal_id": F.lit("old"), "gender": F.lit("seed")})
    after = changes.apply_changes(target, rows, gold.KEYS[table], mapped, ["arrival", "seq"])
    return after.select("user_id", "first_name", "last_name", "fiscal_id", "gender")


# -- reading plan -----------------------------------------------------------------------------------------------------
def reading_events(t) -> DataFrame:
    """Orders as events with zero to three items; some keys only appear from the second item on."""
    item = lambda i: obj(
        type=F.lit("item"), id=s(".o_orderkey", "-", i.cast("string")),
        name=F.when(i > 0, s("name", i.cast("string"))), description=F.when(i == 0, s("d", ".o_custkey")),
        user_id=F.when(i > 0, s("u", ".o_custkey", "-", i.cast("string"))),
        role=F.col("o_orderstatus"), title=F.when(i != 1, F.col("o_orderpriority")),
        action=F.when(i > 0, F.when(F.col("o_orderstatus") == "F", "delete").otherwise("add")),
        ip=F.lit("10.0.0.1"), book_teacher_id=F.when(i == 2, "bt"), total_sessions=i,
        book_pack_ids=F.when(i == 0, F.array(F.col("o_custkey"), F.lit(7).cast("long"))),
    )
    kind = F.when(F.col("o_orderstatus") == "P", "other").when(F.col("o_custkey") % 2 == 0, "acceso").otherwise("callback")
    event = obj(
        type=kind, action=s("Act ", ".o_orderstatus"), description=F.when(F.col("o_custkey") % 5 != 0, F.lit("desc")),
        info=F.when(F.col("o_custkey") % 3 == 0, obj(
            user_id=_text("o_custkey"), product_id=F.lit("prod"),
            http_flow=F.when(F.col("o_custkey") % 2 == 0, obj(origin=F.lit("org"), target=F.lit("tgt"))),
        )),
        data=_items((F.col("o_custkey") % 4).cast("int"), item),
    )
    return document(spread(t.orders, "o_orderkey"), event)


ITEMS_SQL = "(SELECT *, o_custkey % 4 AS n FROM orders, range(0, 3) AS r(i) WHERE i < o_custkey % 4)"
ABSENT = {c: "''" for c in reading.ITEM_LEVEL}
STREAM_SQL = ABSENT | {
    "type": "'item'", "id": "o_orderkey || '-' || i", "name": "CASE WHEN i > 0 THEN 'name' || i ELSE '' END",
    "description": "CASE WHEN i = 0 THEN 'd' || o_custkey ELSE '' END",
    "user_id": "CASE WHEN n > 1 THEN 'u' || o_custkey || '-1' END", "role": "o_orderstatus",
    "title": "CASE WHEN i <> 1 THEN o_orderpriority ELSE '' END",
    "action": "CASE WHEN i = 0 THEN '' WHEN o_orderstatus = 'F' THEN 'delete' ELSE 'add' END", "ip_address": "'10.0.0.1'",
    "book_teacher_path_id": "CASE WHEN i = 2 THEN 'bt' ELSE '' END", "total_sessions": _str("i"),
    "book_pack_ids": "CASE WHEN i = 0 THEN '[' || o_custkey || ',7]' END",
    "type_event": "CASE WHEN o_custkey % 2 = 0 THEN 'acceso' ELSE 'callback' END", "action_event": "'Act ' || o_orderstatus",
    "description_event": "CASE WHEN o_custkey % 5 <> 0 THEN 'desc' ELSE '' END",
}


@query("reading_stream_lql", table_sql(reading.TABLE, STREAM_SQL, f"FROM {ITEMS_SQL} WHERE o_orderstatus <> 'P'"))
def reading_stream(t):
    return reading.from_stream(reading_events(t)).select(*gold.data_columns(reading.TABLE))


def _info(condition: str, value: str) -> str:
    return f"CASE WHEN o_custkey % 3 = 0 AND {condition} THEN {value} ELSE '{reading.NO_INFO}' END"


QUEUE_SQL = {
    "type": "'item'", "id": "o_orderkey || '-' || i", "name": "CASE WHEN n > 1 THEN 'name1' END", "description": "'d' || o_custkey",
    "user_id": "CASE WHEN n > 1 THEN 'u' || o_custkey || '-1' END", "role": "o_orderstatus",
    "title": "CASE WHEN i <> 1 THEN o_orderpriority END",
    "action": "CASE WHEN n > 1 THEN CASE WHEN o_orderstatus = 'F' THEN 'delete' ELSE 'add' END END", "ip_address": "'10.0.0.1'",
    "book_teacher_path_id": "CASE WHEN i = 2 THEN 'bt' END", "total_sessions": _str("i"),
    "book_pack_ids": "CASE WHEN i = 0 THEN '[' || o_custkey || ',7]' END",
    "type_event": "CASE WHEN o_orderstatus = 'P' THEN 'other' WHEN o_custkey % 2 = 0 THEN 'acceso' ELSE 'callback' END",
    "action_event": "'Act ' || o_orderstatus", "description_event": "CASE WHEN o_custkey % 5 <> 0 THEN 'desc' END",
    "info_user_cookie_session_id": f"'{reading.NO_INFO}'", "info_school_id": f"'{reading.NO_INFO}'",
    "info_user_id": _info("true", _str("o_custkey")), "info_product_id": _info("true", "'prod'"),
    "info_origin": _info("o_custkey % 2 = 0", "'org'"), "info_referrer": f"'{reading.NO_INFO}'",
    "info_target": _info("o_custkey % 2 = 0", "'tgt'"),
}


@query("reading_queue_lql", table_sql(reading.TABLE, QUEUE_SQL, f"FROM {ITEMS_SQL}"))
def reading_queue(t):
    return reading.from_queue(reading_events(t)).select(*gold.data_columns(reading.TABLE))


@query(
    "reading_queue_apply",
    f"""WITH rows AS (SELECT o_orderkey || '-' || i AS id, n > 1 AND o_orderstatus = 'F' AS gone, 'new' AS src FROM {ITEMS_SQL}),
          target AS (SELECT o_orderkey || '-0' AS id, 'old' AS src FROM orders)
        SELECT id, count(*) AS n FROM (SELECT id FROM target UNION ALL SELECT id FROM rows WHERE NOT gone)
        WHERE id NOT IN (SELECT id FROM rows WHERE gone) GROUP BY id""",
)
def reading_apply(t):
    """Queue rows applied to the table: appends, then deletes by item id."""
    rows = reading.from_queue(reading_events(t)).select("id", "action")
    target = t.orders.select(s(".o_orderkey", "-0").alias("id"), F.lit("old").alias("action"))
    return changes.append_then_delete(target, rows).groupBy("id").agg(F.count("*").alias("n"))
