"""DuckDB oracle SQL for every registered query.

Where the Spark side rewrites the job (one-pass pivot, semi-join, narrow dedupes),
the SQL keeps the job's *original* form: eight self-joins, outer join + NOT NULL +
DISTINCT, wide DISTINCT.  The upsert's text and number rule is restated here, so it
cannot catch a mistake in the rule itself; the columns ``big``, ``rate`` and ``tags``
are compared by what must come out, and ``tests/test_upsert_types.py`` states the
rest by value.  The derived
input tables are inlined as CTEs (the driver registers only raw tables).
"""

from __future__ import annotations

from quillmart.sources.fixtures import oracle_ctes

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
TODAY = "DATE '1997-12-16'"
NY = "America/New_York"
ORDER_T = "upserted_at DESC NULLS LAST, version_id DESC NULLS LAST"


def to_utc(x: str, zone: str = NY) -> str:
    return f"timezone('UTC', timezone('{zone}', {x}))"


def json_first(x: str) -> str:
    return (f"CASE WHEN NOT json_valid({x}) THEN NULL "
            f"WHEN json_type({x}, '$[0]') IN ('OBJECT', 'ARRAY') THEN NULL "
            f"ELSE json_extract_string({x}, '$[0]') END")


URL_ID = "nullif(regexp_extract({x}, '(?:/project/|/0/)(\\d+)(?:/|$)', 1), '')"

# Pivoted attribute -> (fixture field id, column) in the job's order.
FIELDS = [
    ("click", "cf_priority"), ("error", "cf_effort_score"), ("signup", "cf_raw_original_due_date"),
    ("purchase", "cf_raw_original_due_date_change_count"),
    ("view", "cf_task_type_cswo_wp"), ("click", "cf_task_type_cswo_crm"),
    ("error", "cf_task_type_cswo_rca"), ("view", "cf_task_source"),
]

TASK_CTE = f"""task AS (
  SELECT upserted_at AS _upserted_at, version_id AS _version, gid AS task_id, name AS task_name,
    is_deleted AS task_is_deleted, resource_type AS task_resource_type,
    resource_subtype AS task_resource_subtype, assignee_gid AS task_assignee_id,
    html_notes AS task_html_description, notes AS task_text_description, permalink_url AS task_link,
    created_at AS task_created_at, modified_at AS task_modified_at, due_at AS task_due_at,
    CAST(due_on AS DATE) AS task_due_date, completed AS task_is_completed,
    completed_by_gid AS task_completed_by, completed_at AS task_completed_at,
    ROW_NUMBER() OVER (PARTITION BY gid ORDER BY {ORDER_T}) AS task_rn
  FROM f_task)"""

CFV_CTE = f"""cfv AS (
  SELECT DISTINCT task_gid, field_gid, display_value,
    ROW_NUMBER() OVER (PARTITION BY task_gid, field_gid ORDER BY {ORDER_T}) AS rn
  FROM f_cfv)"""

USER_CTE = f"""usr AS (
  SELECT gid, name, email, ROW_NUMBER() OVER (PARTITION BY gid ORDER BY {ORDER_T}) AS rn FROM f_user)"""

WORKER_CTE = """worker AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY worker_email
      ORDER BY effective_from DESC NULLS LAST, version_id DESC NULLS LAST) AS rn
    FROM f_pay_rate) WHERE rn = 1)"""


def lifecycle_case(f: str = "CAST(c.property_effective_from AS DATE)",
                   t: str = "CAST(c.property_effective_to AS DATE)", d: str = TODAY) -> str:
    return (f"CASE WHEN {f} <= {d} AND {t} IS NULL THEN 'active' "
            f"WHEN {f} <= {d} AND {d} <= {t} THEN 'cancelling' "
            f"WHEN {f} < {d} AND {t} < {d} THEN 'former' "
            f"WHEN {d} < {f} THEN 'future' END")


def lifecycle_where() -> str:
    f, t, d = "CAST(c.property_effective_from AS DATE)", "CAST(c.property_effective_to AS DATE)", TODAY
    return (f"(({f} <= {d} AND c.property_effective_to IS NULL) OR ({f} <= {d} AND {d} <= {t}) "
            f"OR ({f} < {d} AND {t} < {d}) OR ({d} < {f}))")


DEAL_ON = ("d.deal_pipeline_stage_id IN ('F') AND upper(d.property_dealtype) NOT IN ('5-LOW', '2-HIGH') "
           "AND d.property_effective_from IS NOT NULL AND d.is_deleted != TRUE")

BM_COMPANY_CTE = f"""bm_company AS (
  SELECT DISTINCT c.id AS company_id, c.property_name AS company_name,
    c.property_asana_project AS asana_project_link,
    {URL_ID.format(x='c.property_asana_project')} AS asana_project_id,
    c.property_client_status AS company_status,
    bd.first_name || ' ' || bd.last_name AS company_brand_director,
    bm.first_name || ' ' || bm.last_name AS company_brand_manager
  FROM f_company c
  LEFT JOIN (SELECT DISTINCT company_id, deal_id FROM f_deal_company) dc ON c.id = dc.company_id
  LEFT JOIN (SELECT DISTINCT * FROM f_deal) d ON dc.deal_id = d.deal_id AND {DEAL_ON}
  LEFT JOIN f_owner bd ON c.property_brand_director = bd.owner_id
  LEFT JOIN f_owner bm ON c.property_brand_manager = bm.owner_id
  WHERE c.id IS NOT NULL AND c.is_deleted = FALSE AND c.property_effective_from IS NOT NULL
    AND {lifecycle_where()} AND d.deal_id IS NOT NULL)"""

LAST_DUE = to_utc("coalesce(t.task_due_at, CAST(t.task_due_date AS TIMESTAMP) + INTERVAL '86399' SECOND)")


def _field_joins() -> str:
    out = []
    for fid, col in FIELDS:
        a = f"f_{col}"
        out.append(f"LEFT JOIN cfv AS {a} ON t.task_id = {a}.task_gid AND {a}.field_gid = '{fid}' AND {a}.rn = 1")
    return "\n  ".join(out)


STG_CTE = f"""stg AS (
  SELECT DISTINCT
    t.task_id, t.task_name, t.task_is_deleted, t.task_resource_type, t.task_resource_subtype,
    t.task_assignee_id, assignee.name AS task_assignee_name, assignee.email AS task_assignee_email,
    worker.position_title AS task_assignee_position,
    t.task_html_description, t.task_text_description, t.task_link,
    t.task_created_at, t.task_modified_at, t.task_due_at, t.task_due_date,
    {LAST_DUE} AS task_last_due_date,
    coalesce({to_utc("strptime(f_cf_raw_original_due_date.display_value, '%m/%d/%Y %H:%M:%S')")},
             {LAST_DUE}) AS task_original_due_date,
    t.task_is_completed, t.task_completed_by, completed_by.name AS task_completed_by_name,
    t.task_completed_at,
    CASE WHEN t.task_is_completed THEN t.task_id ELSE NULL END AS task_completion_id,
    CASE WHEN t.task_is_completed THEN NULL ELSE t.task_id END AS task_active_id,
    p.project_id, p.project_name,
    c.company_id, c.company_name, c.company_status, c.company_brand_director, c.company_brand_manager,
    {", ".join(f"f_{col}.display_value AS {col}" for _, col in FIELDS)}
  FROM task t
  {_field_joins()}
  LEFT JOIN (SELECT DISTINCT task_gid AS task_id, project_gid AS project_id FROM f_task_project) tp
    ON t.task_id = tp.task_id
  LEFT JOIN (SELECT gid AS project_id, name AS project_name,
               ROW_NUMBER() OVER (PARTITION BY gid ORDER BY {ORDER_T}) AS rn FROM f_project) p
    ON tp.project_id = p.project_id AND p.rn = 1
  LEFT JOIN usr AS assignee ON t.task_assignee_id = assignee.gid AND assignee.rn = 1
  LEFT JOIN worker ON assignee.email = worker.worker_email
  LEFT JOIN usr AS completed_by ON t.task_completed_by = completed_by.gid AND completed_by.rn = 1
  LEFT JOIN bm_company c ON CAST(p.project_id AS VARCHAR) = c.asana_project_id
  WHERE t.task_is_deleted != TRUE AND t.task_rn = 1)"""

STG_FIXTURES = ["f_task", "f_cfv", "f_task_project", "f_project", "f_user", "f_pay_rate",
                "f_company", "f_deal_company", "f_deal", "f_owner", "f_workers"]


def stg_with() -> str:
    return (oracle_ctes(STG_FIXTURES) + ", " + ",\n".join(
        [TASK_CTE, CFV_CTE, USER_CTE, WORKER_CTE, BM_COMPANY_CTE, STG_CTE]) + "\n")


HEAD = ("t.task_id, t.task_name, t.task_is_deleted, t.task_resource_type, t.task_resource_subtype, "
        "t.task_assignee_id, t.task_assignee_name, t.task_assignee_email, t.task_assignee_position, "
        "t.task_html_description, t.task_text_description, t.task_link, "
        "t.task_created_at, t.task_modified_at, t.task_due_at, t.task_due_date, t.task_last_due_date, "
        "t.task_original_due_date")

STATUS = ("CASE WHEN t.task_is_completed THEN t.task_id ELSE NULL END AS task_is_completed, "
          "CASE WHEN t.task_is_completed = FALSE THEN t.task_id ELSE NULL END AS task_is_active")

METRICS = f"""date_sub('hour', t.task_created_at, coalesce(t.task_completed_at, {AS_OF})) AS task_turn_around_time,
    date_sub('hour', t.task_completed_at, t.task_original_due_date) AS task_completion_from_original_due_date_time,
    date_sub('day', t.task_completed_at, t.task_original_due_date) AS task_completion_from_original_due_date_days"""

FLAGS = """CASE WHEN t.task_completed_at < t.task_original_due_date THEN t.task_id ELSE NULL END AS task_is_completed_before_original_due_date,
    CASE WHEN t.task_completed_at < t.task_original_due_date THEN NULL ELSE t.task_id END AS task_is_completed_after_original_due_date,
    CASE WHEN t.task_completed_at < t.task_last_due_date THEN t.task_id ELSE NULL END AS task_is_completed_before_last_due_date,
    CASE WHEN t.task_completed_at < t.task_last_due_date THEN NULL ELSE t.task_id END AS task_is_completed_after_last_due_date,
    CASE WHEN t.task_completed_at <= t.task_original_due_date THEN NULL ELSE t.task_id END AS task_completed_outside_schedule,
    CASE WHEN t.task_last_due_date != t.task_original_due_date THEN NULL
         ELSE CASE WHEN t.task_completed_at <= t.task_original_due_date THEN t.task_id ELSE NULL END
    END AS task_completed_on_time"""

CF = ", ".join(f"t.{c}" for _, c in FIELDS)


def mart_sql(with_brand: bool) -> str:
    brand = "t.company_brand_director, t.company_brand_manager, " if with_brand else ""
    return stg_with() + f"""SELECT DISTINCT {HEAD},
    {STATUS},
    t.task_completed_by, t.task_completed_by_name, t.task_completed_at,
    t.task_completion_id, t.task_active_id,
    {METRICS},
    {FLAGS},
    t.project_id, t.project_name, t.company_id, t.company_name, t.company_status, {brand}
    {json_first('w.manager_name')} AS airtable_manager,
    {json_first('w.director_name')} AS airtable_director,
    {CF}
FROM stg t
LEFT JOIN f_workers w ON t.task_assignee_email = w.work_email_address_copy"""


TASK_FIELDS = ["task_id", "task_name", "task_is_deleted", "task_resource_type", "task_resource_subtype",
               "task_assignee_id", "task_html_description", "task_text_description", "task_link",
               "task_created_at", "task_modified_at", "task_due_at", "task_due_date",
               "task_is_completed", "task_completed_by", "task_completed_at"]

# Current items with the pivoted original-due text, due instants and ids.
TASK_LEVEL_CTE = f"""tl AS (
  SELECT t.*, {LAST_DUE} AS task_last_due_date,
    coalesce({to_utc("strptime(f_cf_raw_original_due_date.display_value, '%m/%d/%Y %H:%M:%S')")},
             {LAST_DUE}) AS task_original_due_date
  FROM task t
  LEFT JOIN cfv AS f_cf_raw_original_due_date ON t.task_id = f_cf_raw_original_due_date.task_gid
    AND f_cf_raw_original_due_date.field_gid = 'signup' AND f_cf_raw_original_due_date.rn = 1
  WHERE t.task_is_deleted != TRUE AND t.task_rn = 1)"""


def task_level_with() -> str:
    return oracle_ctes(["f_task", "f_cfv"]) + ", " + ",\n".join([TASK_CTE, CFV_CTE, TASK_LEVEL_CTE]) + "\n"


def people_with(workers: bool = False) -> str:
    names = ["f_task", "f_user", "f_pay_rate"] + (["f_workers"] if workers else [])
    return oracle_ctes(names) + ", " + ",\n".join([TASK_CTE, USER_CTE, WORKER_CTE]) + "\n"


PEOPLE_FROM = """FROM task t
  LEFT JOIN usr AS assignee ON t.task_assignee_id = assignee.gid AND assignee.rn = 1
  LEFT JOIN worker ON assignee.email = worker.worker_email
  LEFT JOIN usr AS completed_by ON t.task_completed_by = completed_by.gid AND completed_by.rn = 1"""

# ---- upsert equality in DuckDB ------------------------------------------------
#: Numeric text by DuckDB's own parser; an underscore stands between two digits only.
IS_NUM = ("(TRY_CAST(replace(trim({x}), '_', '') AS DOUBLE) IS NOT NULL "
          "AND NOT regexp_matches({x}, '(^|[^0-9])_|_([^0-9]|$)'))")


def canon(x: str, kind: str) -> tuple[str, str, str]:
    """(kind, number, text) SQL for column ``x`` of type kind in {str, num, bool}."""
    if kind == "bool":
        return (f"CASE WHEN {x} IS NOT NULL THEN 'bool' END", f"CAST({x} AS DOUBLE)", "NULL")
    if kind == "num":
        return (f"CASE WHEN {x} IS NOT NULL THEN 'num' END", f"CAST({x} AS DOUBLE)", "NULL")
    is_bool = f"lower({x}) IN ('true', 'false')"
    is_json = f"(starts_with({x}, '{{') OR starts_with({x}, '[')) AND json_valid({x})"
    is_num = IS_NUM.format(x=x)
    k = (f"CASE WHEN {x} IS NULL THEN NULL WHEN {is_bool} THEN 'bool' WHEN {is_json} THEN 'json' "
         f"WHEN {is_num} THEN 'num' ELSE 'text' END")
    n = (f"CASE WHEN {is_bool} THEN CAST(lower({x}) = 'true' AS DOUBLE) "
         f"WHEN {is_json} THEN NULL WHEN {is_num} THEN TRY_CAST(replace(trim({x}), '_', '') AS DOUBLE) END")
    jt = (f"(SELECT string_agg(fullkey || '=' || coalesce(CAST(atom AS VARCHAR), type), ',' ORDER BY fullkey) "
          f"FROM json_tree(CASE WHEN {is_json} THEN {x} ELSE 'null' END))")
    t = f"CASE WHEN {is_json} THEN {jt} ELSE {x} END"
    return k, n, t


def json_paths(x: str) -> str:
    """(path, type, value) of every node of JSON text; of a repeated key the last."""
    return (f"(SELECT list((fullkey, type, atom) ORDER BY fullkey) FROM (SELECT fullkey, arg_max(type, id) AS type, "
            f"arg_max(CASE WHEN type = 'DOUBLE' THEN CAST(CAST(atom AS DOUBLE) AS VARCHAR) ELSE CAST(atom AS VARCHAR) END, id) AS atom "
            f"FROM json_tree({x}) GROUP BY fullkey))")


def list_text(x: str) -> str:
    return f"CAST(to_json({x}) AS VARCHAR)"


def equal_sql(a: str, at: str, b: str, bt: str) -> str:
    if at == "paths":
        return f"({json_paths(a)} IS NOT DISTINCT FROM {json_paths(b)})"
    if at == "own":
        return f"({a} IS NOT DISTINCT FROM {list_text(b) if bt == 'list' else b})"
    ka, na, ta = canon(a, at)
    kb, nb, tb = canon(b, bt)
    return (f"(CASE WHEN ({ka}) IS NULL AND ({kb}) IS NULL THEN TRUE "
            f"WHEN ({ka}) IS NULL OR ({kb}) IS NULL THEN FALSE "
            f"WHEN ({ka}) = 'json' AND ({kb}) = 'json' THEN ({ta}) = ({tb}) "
            f"WHEN ({ka}) = 'bool' AND ({kb}) = 'bool' THEN ({na}) = ({nb}) "
            f"WHEN ({ka}) IN ('bool', 'num') AND ({kb}) IN ('bool', 'num') THEN ({na}) = ({nb}) "
            f"ELSE ({ka}) = ({kb}) AND ({ta}) IS NOT DISTINCT FROM ({tb}) END)")


# incoming column -> (stored type, incoming type); priority is new (stored NULL string).
# big and tags state what the rule must give for them, not the rule itself: whole numbers
# exactly, a list equal to its stored JSON text.  rate compares the nodes of its JSON.
SYNC_COLS = [("status", "str", "str"), ("price", "num", "num"), ("code", "str", "str"),
             ("flag", "bool", "str"), ("payload", "str", "str"), ("priority", "str", "str"),
             ("big", "own", "own"), ("rate", "paths", "paths"), ("tags", "own", "list")]


def sync_with() -> str:
    eqs = ",\n    ".join(equal_sql(f"e.{c}", st, f"i.{c}", it) + f" AS {c}_equal"
                         for c, st, it in SYNC_COLS)
    return oracle_ctes(["f_sync_existing", "f_sync_incoming"]) + f""",
ev AS (SELECT *, CAST(NULL AS VARCHAR) AS priority FROM f_sync_existing),
eq AS (
  SELECT i.ref_id, e.ref_id IS NOT NULL AS hit,
    {eqs}
  FROM f_sync_incoming i LEFT JOIN ev e ON i.ref_id = e.ref_id),
cls AS (
  SELECT ref_id,
    CASE WHEN NOT hit THEN 'insert'
         WHEN {" AND ".join(f"{c}_equal" for c, _, _ in SYNC_COLS)} THEN 'unchanged' ELSE 'update' END AS action,
    CASE WHEN hit AND NOT ({" AND ".join(f"{c}_equal" for c, _, _ in SYNC_COLS)}) THEN
      concat_ws(',', {", ".join(f"CASE WHEN NOT {c}_equal THEN '{c}' END" for c, _, _ in SYNC_COLS)}) END
      AS changed_columns,
    {", ".join(f"{c}_equal" for c, _, _ in SYNC_COLS)}
  FROM eq
  UNION ALL
  SELECT e.ref_id, 'keep', NULL, {", ".join("NULL" for _ in SYNC_COLS)}
  FROM ev e WHERE e.ref_id NOT IN (SELECT ref_id FROM f_sync_incoming))
"""


def sync_upsert_sql() -> str:
    def val(c: str, st: str, it: str) -> str:
        new = f"i.{c}"
        if st == "bool" and it == "str":
            new = f"CASE WHEN lower(i.{c}) = 'true' THEN TRUE WHEN lower(i.{c}) = 'false' THEN FALSE END"
        if it == "list":
            new = list_text(new)
        return f"CASE WHEN c.action = 'insert' OR NOT c.{c}_equal THEN {new} ELSE e.{c} END AS {c}"
    cols = ",\n    ".join(val(c, st, it) for c, st, it in SYNC_COLS)
    return sync_with() + f"""SELECT c.ref_id,
    {cols},
    CASE WHEN c.action IN ('insert', 'update') THEN {AS_OF} ELSE e.synced_at END AS synced_at
FROM cls c JOIN f_sync_incoming i ON c.ref_id = i.ref_id LEFT JOIN ev e ON c.ref_id = e.ref_id
UNION ALL BY NAME
SELECT * FROM ev WHERE ref_id NOT IN (SELECT ref_id FROM f_sync_incoming)"""


def cell_diff_sql() -> str:
    parts = []
    for c, _, it in SYNC_COLS:
        new = list_text(f"i.{c}") if it == "list" else f"CAST(i.{c} AS VARCHAR)"
        parts.append(f"SELECT c.ref_id, '{c}' AS column_name, CAST(e.{c} AS VARCHAR) AS existing_value, "
                     f"{new} AS new_value FROM cls c JOIN f_sync_incoming i ON c.ref_id = i.ref_id "
                     f"JOIN ev e ON c.ref_id = e.ref_id WHERE c.action = 'update' AND NOT c.{c}_equal")
    return sync_with() + "\nUNION ALL\n".join(parts)


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    tf = ", ".join(f"t.{c}" for c in TASK_FIELDS)
    # sources
    q["rename_projection"] = oracle_ctes(["f_task"]) + ", " + TASK_CTE + \
        "\nSELECT * EXCLUDE (task_rn) FROM task"
    q["run_query_text"] = oracle_ctes(["f_task"]) + """
SELECT task_id, task_name, task_assignee_id
FROM (SELECT gid AS task_id, name AS task_name, assignee_gid AS task_assignee_id, is_deleted,
             row_number() OVER (PARTITION BY gid
                                ORDER BY upserted_at DESC NULLS LAST, version_id DESC NULLS LAST) AS rn
      FROM f_task)
WHERE rn = 1 AND is_deleted != TRUE"""
    q["keyed_lookup"] = oracle_ctes(["f_sync_existing", "f_sync_incoming"]) + \
        "SELECT * FROM f_sync_existing WHERE ref_id IN (SELECT ref_id FROM f_sync_incoming)"
    q["code_lookup"] = """SELECT c.c_custkey, printf('%03d', c.c_nationkey) AS country_code, n.n_name AS country_name
FROM customer c LEFT JOIN nation n ON printf('%03d', c.c_nationkey) = printf('%03d', n.n_nationkey)"""
    q["mart_write_readback"] = mart_sql(True)
    # filters / versions
    q["null_rejecting_filters"] = oracle_ctes(["f_deal"]) + f"SELECT * FROM f_deal d WHERE {DEAL_ON}"
    q["lifecycle_status"] = oracle_ctes(["f_company"]) + f"""SELECT * FROM (
  SELECT c.id AS company_id, c.property_name AS company_name, {lifecycle_case()} AS lifecycle
  FROM f_company c
  WHERE c.id IS NOT NULL AND c.is_deleted = FALSE AND c.property_effective_from IS NOT NULL)
WHERE lifecycle IS NOT NULL"""
    q["current_items"] = oracle_ctes(["f_task"]) + ", " + TASK_CTE + \
        "\nSELECT * EXCLUDE (task_rn) FROM task WHERE task_rn = 1 AND task_is_deleted != TRUE"
    q["version_rank"] = oracle_ctes(["f_task"]) + ", " + TASK_CTE + \
        "\nSELECT task_id, _version, _upserted_at, task_rn FROM task"
    q["latest_version"] = oracle_ctes(["f_user"]) + f"""SELECT user_id, user_name, user_email, _upserted_at, _version FROM (
  SELECT gid AS user_id, name AS user_name, email AS user_email, upserted_at AS _upserted_at,
    version_id AS _version, ROW_NUMBER() OVER (PARTITION BY gid ORDER BY {ORDER_T}) AS rn FROM f_user)
WHERE rn = 1"""
    q["worker_latest_rate"] = oracle_ctes(["f_pay_rate"]) + ", " + WORKER_CTE + \
        "\nSELECT worker_email, effective_from, position_title, version_id AS _version FROM worker"
    joins = "\n  ".join(
        f"LEFT JOIN cfv AS f_{col} ON e.task_id = f_{col}.task_gid AND f_{col}.field_gid = '{fid}' AND f_{col}.rn = 1"
        for fid, col in FIELDS)
    ids = ", ".join(f"'{fid}'" for fid, _ in FIELDS)
    q["attribute_pivot"] = oracle_ctes(["f_cfv"]) + ", " + CFV_CTE + f"""
SELECT e.task_id, {", ".join(f"f_{col}.display_value AS {col}" for _, col in FIELDS)}
FROM (SELECT DISTINCT task_gid AS task_id FROM f_cfv WHERE field_gid IN ({ids})) e
  {joins}"""
    q["distinct_pairs"] = oracle_ctes(["f_task_project"]) + \
        "SELECT DISTINCT task_gid AS task_id, project_gid AS project_id FROM f_task_project"
    # joins
    q["assignee_enrichment"] = people_with() + f"""SELECT t.task_id, t.task_assignee_id,
  assignee.name AS task_assignee_name, assignee.email AS task_assignee_email,
  worker.position_title AS task_assignee_position
{PEOPLE_FROM}
WHERE t.task_rn = 1 AND t.task_is_deleted != TRUE"""
    q["two_role_join"] = people_with() + f"""SELECT t.task_id, t.task_assignee_id,
  assignee.name AS task_assignee_name, t.task_completed_by, completed_by.name AS task_completed_by_name
{PEOPLE_FROM}
WHERE t.task_rn = 1 AND t.task_is_deleted != TRUE"""
    q["worker_managers"] = people_with(True) + f"""SELECT DISTINCT t.task_id, assignee.email AS task_assignee_email,
  {json_first('w.manager_name')} AS airtable_manager, {json_first('w.director_name')} AS airtable_director
{PEOPLE_FROM}
  LEFT JOIN f_workers w ON assignee.email = w.work_email_address_copy
WHERE t.task_rn = 1 AND t.task_is_deleted != TRUE"""
    q["filtered_right_left_join"] = oracle_ctes(["f_company", "f_deal_company", "f_deal"]) + f"""
SELECT c.id AS company_id, dc.deal_id, d.deal_id AS qualifying_deal_id
FROM f_company c
LEFT JOIN (SELECT DISTINCT company_id, deal_id FROM f_deal_company) dc ON c.id = dc.company_id
LEFT JOIN (SELECT DISTINCT * FROM f_deal) d ON dc.deal_id = d.deal_id AND {DEAL_ON}"""
    q["item_project_bridge"] = oracle_ctes(["f_task", "f_task_project", "f_project"]) + ", " + TASK_CTE + f"""
SELECT DISTINCT t.task_id, p.project_id, p.project_name
FROM task t
LEFT JOIN (SELECT DISTINCT task_gid AS task_id, project_gid AS project_id FROM f_task_project) tp
  ON t.task_id = tp.task_id
LEFT JOIN (SELECT gid AS project_id, name AS project_name,
             ROW_NUMBER() OVER (PARTITION BY gid ORDER BY {ORDER_T}) AS rn FROM f_project) p
  ON tp.project_id = p.project_id AND p.rn = 1
WHERE t.task_rn = 1 AND t.task_is_deleted != TRUE"""
    q["company_by_project_link"] = oracle_ctes(["f_project", "f_company", "f_deal_company", "f_deal", "f_owner"]) \
        + ", " + BM_COMPANY_CTE + f"""
SELECT DISTINCT p.project_id, p.project_name, c.company_id, c.company_name
FROM (SELECT gid AS project_id, name AS project_name,
        ROW_NUMBER() OVER (PARTITION BY gid ORDER BY {ORDER_T}) AS rn FROM f_project) p
LEFT JOIN bm_company c ON CAST(p.project_id AS VARCHAR) = c.asana_project_id
WHERE p.rn = 1"""
    q["engaged_company"] = oracle_ctes(["f_company", "f_deal_company", "f_deal", "f_owner"]) + ", " + \
        BM_COMPANY_CTE + "\nSELECT * FROM bm_company"
    # scalars
    q["url_id_extract"] = oracle_ctes(["f_company"]) + \
        f"SELECT id AS company_id, property_asana_project, {URL_ID.format(x='property_asana_project')} AS asana_project_id FROM f_company"
    q["full_name"] = oracle_ctes(["f_company", "f_owner"]) + """SELECT c.id AS company_id,
  bd.first_name || ' ' || bd.last_name AS company_brand_director
FROM f_company c LEFT JOIN f_owner bd ON c.property_brand_director = bd.owner_id"""
    q["json_first_scalar"] = oracle_ctes(["f_workers"]) + f"""SELECT work_email_address_copy,
  {json_first('manager_name')} AS airtable_manager, {json_first('director_name')} AS airtable_director
FROM f_workers"""
    q["parse_custom_due"] = oracle_ctes(["f_cfv"]) + f"""SELECT task_gid AS task_id, version_id AS _version, display_value,
  {to_utc("strptime(display_value, '%m/%d/%Y %H:%M:%S')")} AS original_due_utc
FROM f_cfv WHERE field_gid = 'signup'"""
    # metrics
    q["due_instants"] = task_level_with() + """SELECT task_id, task_created_at, task_modified_at, task_due_at,
  task_due_date, task_last_due_date, task_original_due_date, task_completed_at FROM tl"""
    q["turnaround_hours"] = task_level_with() + \
        f"SELECT t.task_id, date_sub('hour', t.task_created_at, coalesce(t.task_completed_at, {AS_OF})) AS task_turn_around_time FROM tl t"
    q["due_variance"] = task_level_with() + """SELECT t.task_id,
  date_sub('hour', t.task_completed_at, t.task_original_due_date) AS task_completion_from_original_due_date_time,
  date_sub('day', t.task_completed_at, t.task_original_due_date) AS task_completion_from_original_due_date_days
FROM tl t"""
    q["sla_flags"] = task_level_with() + f"""SELECT t.task_id,
  CASE WHEN t.task_is_completed THEN t.task_id ELSE NULL END AS task_completion_id,
  CASE WHEN t.task_is_completed THEN NULL ELSE t.task_id END AS task_active_id,
  {STATUS},
  {FLAGS}
FROM tl t"""
    # marts
    q["denormalized_items"] = stg_with() + "SELECT * FROM stg"
    q["item_mart"] = mart_sql(True)
    q["adherence_mart"] = mart_sql(False)
    # sync
    q["sync_evolve"] = oracle_ctes(["f_sync_existing"]) + \
        "SELECT *, CAST(NULL AS VARCHAR) AS priority FROM f_sync_existing"
    q["values_equal"] = sync_with() + \
        f"SELECT ref_id, {', '.join(f'{c}_equal' for c, _, _ in SYNC_COLS)} FROM eq WHERE hit"
    q["sync_bool_coerce"] = oracle_ctes(["f_sync_incoming"]) + """SELECT ref_id,
  CASE WHEN lower(flag) = 'true' THEN TRUE WHEN lower(flag) = 'false' THEN FALSE END AS flag
FROM f_sync_incoming"""
    q["sync_json_encode"] = oracle_ctes(["f_sync_incoming"]) + \
        "SELECT ref_id, CAST(to_json({'status': status, 'price': price, 'priority': priority}) AS VARCHAR) AS record FROM f_sync_incoming"
    q["classify_changes"] = sync_with() + "SELECT ref_id, action, changed_columns FROM cls"
    q["cell_diff"] = cell_diff_sql()
    q["sync_upsert"] = sync_upsert_sql()
    q["sync_summary"] = sync_with() + "SELECT action, count(*) AS n FROM cls GROUP BY action"
    return q
