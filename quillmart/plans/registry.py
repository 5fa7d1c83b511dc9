"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the derived fixture tables)
and runs over them whole.  Parameters are the fixed oracle parameters:
``as_of`` 2002-01-01 00:00 UTC, lifecycle date 1997-12-16, stage 'F',
excluded types 5-LOW / 2-HIGH.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.functions.scalars import coerce_bool, full_name, json_first_scalar, url_id
from quillmart.functions.timeutil import parse_local_timestamp
from quillmart.operators.attributes import FIXTURE_FIELDS
from quillmart.operators.companies import current_companies, engaged_companies, qualifying_deals
from quillmart.operators.items import (
    Layouts,
    Params,
    Sources,
    people_joins,
    attach_companies,
    company_dimension,
    current_items,
    denormalize_items,
    item_fields,
    item_projects,
    latest_pay_rate,
)
from quillmart.operators.metrics import completion_ids, due_instants, sla_flags, sla_metrics, status_flags
from quillmart.operators.staging import (
    FIXTURE_FIELD_VALUE,
    FIXTURE_PAY_RATE,
    FIXTURE_PROJECT,
    FIXTURE_TASK,
    FIXTURE_TASK_PROJECT,
    FIXTURE_USER,
    stage,
    version_order,
)
from quillmart.operators.sync import (
    apply_upsert,
    cell_diff,
    classify_changes,
    evolve_schema,
    json_encoded,
    keyed_lookup,
    upsert_summary,
    values_equal,
)
from quillmart.operators.versions import latest_version, version_rank
from quillmart.plans.marts import ITEM_MART_CLUSTER, MART_ROW, PARTITION_SOURCE, adherence_mart_frame, item_mart_frame
from quillmart.session import scratch_dir
from quillmart.sources.fixtures import Fixtures
from quillmart.sources.lookup import code_lookup, code_table
from quillmart.sources.query import run_query
from quillmart.sources.sink import read_mart, write_mart

AS_OF = dt.datetime(2002, 1, 1, 0, 0, 0)
TODAY = dt.date(1997, 12, 16)


def params() -> Params:
    """The fixed oracle parameters, with the layouts of the derived tables."""
    return Params(as_of=AS_OF, today=TODAY, stages=("F",), excluded_types=("5-LOW", "2-HIGH"), fields=FIXTURE_FIELDS,
                  layouts=Layouts(FIXTURE_TASK, FIXTURE_TASK_PROJECT, FIXTURE_PROJECT, FIXTURE_USER,
                                  FIXTURE_FIELD_VALUE, FIXTURE_PAY_RATE))


def sources(fx: Fixtures) -> Sources:
    return Sources(task=fx["f_task"], task_project=fx["f_task_project"], project=fx["f_project"],
                   user=fx["f_user"], field_value=fx["f_cfv"], pay_rate=fx["f_pay_rate"],
                   workers=fx["f_workers"], company=fx["f_company"],
                   deal_company=fx["f_deal_company"], deal=fx["f_deal"], owner=fx["f_owner"])


_FIXTURES: dict[tuple[str, str], Fixtures] = {}


def fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    """Derived tables per (application, folder); frames are immutable, so queries share them."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _FIXTURES or _FIXTURES[k].spark is not spark:
        _FIXTURES[k] = Fixtures(spark, sf_dir)
    return _FIXTURES[k]


def _src(spark: SparkSession, sf_dir: str) -> tuple[Fixtures, Sources, Params]:
    fx = fixtures(spark, sf_dir)
    return fx, sources(fx), params()


def _task_level(src: Sources, p: Params):
    """Current items with fields, due instants and completion ids (no projects)."""
    items = current_items(src, p).join(item_fields(src, p), "task_id", "left")
    return due_instants(items, p.source_zone, p.due_zone, p.strict_parse).select("*", *completion_ids())


# ---------------------------------------------------------------- sources --

def q_rename_projection(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return stage(src.task, p.layouts.task)


RUN_QUERY_TEXT = """
SELECT task_id, task_name, task_assignee_id
FROM (SELECT gid AS task_id, name AS task_name, assignee_gid AS task_assignee_id, is_deleted,
             row_number() OVER (PARTITION BY gid
                                ORDER BY upserted_at DESC NULLS LAST, version_id DESC NULLS LAST) AS rn
      FROM {f_task})
WHERE rn = 1 AND is_deleted != TRUE
"""


def q_run_query_text(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return run_query(spark, text=RUN_QUERY_TEXT, f_task=fx["f_task"])


def q_keyed_lookup(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return keyed_lookup(fx["f_sync_existing"], fx["f_sync_incoming"], "ref_id")


def q_code_lookup(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    cat = fx.catalog
    table = code_table(cat["nation"], "n_nationkey", "n_name")
    return code_lookup(cat["customer"].select("c_custkey", "c_nationkey"), "c_nationkey", table,
                       code_alias="country_code", name_alias="country_name").drop("c_nationkey")


def q_mart_write_readback(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    mart = item_mart_frame(src, p)
    path = scratch_dir(spark, "item-mart")
    write_mart(mart, path, PARTITION_SOURCE, ITEM_MART_CLUSTER, row_columns=MART_ROW)
    return read_mart(spark, path)


# ------------------------------------------------------ filters / versions --

def q_null_rejecting_filters(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return qualifying_deals(src.deal, p.stages, p.excluded_types)


def q_lifecycle_status(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return current_companies(src.company, p.today_col()).select(
        F.col("id").alias("company_id"), F.col("property_name").alias("company_name"), "lifecycle")


def q_current_items(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return current_items(src, p)


def q_version_rank(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    staged = stage(src.task, p.layouts.task).select("task_id", "_version", "_upserted_at")
    return version_rank(staged, ["task_id"], ["_upserted_at", "_version"], rank_col="task_rn")


def q_latest_version(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    lay = p.layouts.user
    return latest_version(stage(src.user, lay), ["user_id"], version_order(lay))


def q_worker_latest_rate(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return latest_pay_rate(src, p)


def q_attribute_pivot(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return item_fields(src, p)


def q_distinct_pairs(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return stage(src.task_project, p.layouts.task_project).select("task_id", "project_id").distinct()


# ------------------------------------------------------------------- joins --

def _people(spark, sf_dir, workers: bool = False):
    _, src, p = _src(spark, sf_dir)
    keys = current_items(src, p).select("task_id", "task_assignee_id", "task_completed_by")
    return people_joins(keys, src, p, src.workers if workers else None)


def q_assignee_enrichment(spark, sf_dir):
    return _people(spark, sf_dir).select("task_id", "task_assignee_id", "task_assignee_name",
                                         "task_assignee_email", "task_assignee_position")


def q_two_role_join(spark, sf_dir):
    return _people(spark, sf_dir).select("task_id", "task_assignee_id", "task_assignee_name",
                                         "task_completed_by", "task_completed_by_name")


def q_worker_managers(spark, sf_dir):
    return (_people(spark, sf_dir, workers=True)
            .select("task_id", "task_assignee_email", "airtable_manager", "airtable_director").distinct())


def q_filtered_right_left_join(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    links = src.deal_company.select("company_id", "deal_id").distinct()
    deals = qualifying_deals(src.deal, p.stages, p.excluded_types).select(
        F.col("deal_id").alias("qualifying_deal_id")).distinct()
    companies = src.company.select(F.col("id").alias("__cid"))
    # company LEFT JOIN links, as inner join + companies without links.  An
    # outer join can only build its non-preserved side (the huge link table);
    # the inner join may build the small company side and stream the links
    # unshuffled, and AQE can split a hot company on either side of it.
    linked = links.join(companies, F.col("company_id") == F.col("__cid"), "inner")
    unlinked = (companies.join(links.select("company_id").distinct(),
                               F.col("__cid") == F.col("company_id"), "left_anti")
                .select("__cid", F.lit(None).cast(links.schema["deal_id"].dataType).alias("deal_id")))
    rows = linked.select("__cid", "deal_id").unionByName(unlinked)
    return (rows.join(deals, F.col("deal_id") == F.col("qualifying_deal_id"), "left")
            .select(F.col("__cid").alias("company_id"), "deal_id", "qualifying_deal_id"))


def q_item_project_bridge(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return (current_items(src, p).select("task_id")
            .join(item_projects(src, p), "task_id", "left"))


def q_company_by_project_link(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    lay = p.layouts.project
    projects = (latest_version(stage(src.project, lay), ["project_id"], version_order(lay))
                .select("project_id", "project_name"))
    comp = company_dimension(src, p, ["company_id", "company_name"])
    return attach_companies(projects, comp)


def q_engaged_company(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return engaged_companies(src.company, src.deal_company, src.deal, src.owner,
                             p.today_col(), p.stages, p.excluded_types)


# ----------------------------------------------------------------- scalars --

def q_url_id_extract(spark, sf_dir):
    _, src, _p = _src(spark, sf_dir)
    return src.company.select(F.col("id").alias("company_id"), "property_asana_project",
                              url_id("property_asana_project").alias("asana_project_id"))


def q_full_name(spark, sf_dir):
    _, src, _p = _src(spark, sf_dir)
    owners = src.owner.select(F.col("owner_id").alias("__oid"),
                              full_name("first_name", "last_name").alias("company_brand_director"))
    return (src.company.join(owners, F.col("property_brand_director") == F.col("__oid"), "left")
            .select(F.col("id").alias("company_id"), "company_brand_director"))


def q_json_first_scalar(spark, sf_dir):
    _, src, _p = _src(spark, sf_dir)
    return src.workers.select("work_email_address_copy",
                              json_first_scalar("manager_name").alias("airtable_manager"),
                              json_first_scalar("director_name").alias("airtable_director"))


def q_parse_custom_due(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    lay = p.layouts.field_value
    due_field = next(a for a, name in p.fields if name == "cf_raw_original_due_date")
    cfv = stage(src.field_value, lay).filter(F.col("field_id") == due_field)
    return cfv.select("task_id", "_version", "display_value",
                      parse_local_timestamp("display_value", p.due_zone, strict=p.strict_parse)
                      .alias("original_due_utc"))


# ----------------------------------------------------------------- metrics --

def q_due_instants(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return _task_level(src, p).select(
        "task_id", "task_created_at", "task_modified_at", "task_due_at", "task_due_date",
        "task_last_due_date", "task_original_due_date", "task_completed_at")


def q_turnaround_hours(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return _task_level(src, p).select("task_id", sla_metrics(p.as_of)[0])


def q_due_variance(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return _task_level(src, p).select("task_id", *sla_metrics(p.as_of)[1:])


def q_sla_flags(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    t = _task_level(src, p)
    return t.select("task_id", "task_completion_id", "task_active_id", *status_flags(), *sla_flags())


# ------------------------------------------------------------------- marts --

def q_denormalized_items(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return denormalize_items(src, p)


def q_item_mart(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return item_mart_frame(src, p)


def q_adherence_mart(spark, sf_dir):
    _, src, p = _src(spark, sf_dir)
    return adherence_mart_frame(src, p)


# -------------------------------------------------------------------- sync --

SYNC_KEY, SYNC_COL = "ref_id", "synced_at"
SYNC_AS_OF = dt.datetime(2002, 1, 1, 0, 0, 0)


def _sync(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return fx["f_sync_existing"], fx["f_sync_incoming"]


def q_sync_evolve(spark, sf_dir):
    t, i = _sync(spark, sf_dir)
    return evolve_schema(t, i, SYNC_COL)


def q_values_equal(spark, sf_dir):
    t, i = _sync(spark, sf_dir)
    ev = evolve_schema(t, i, SYNC_COL)
    tt = {f.name: f.dataType for f in ev.schema.fields}
    ti = {f.name: f.dataType for f in i.schema.fields}
    cols = [c for c in i.columns if c not in (SYNC_KEY, SYNC_COL)]
    old = ev.select(F.col(SYNC_KEY).alias("__k"), *[F.col(c).alias(f"__o_{c}") for c in cols])
    j = i.join(old, F.col(SYNC_KEY) == F.col("__k"), "inner")
    return j.select(SYNC_KEY, *[values_equal(F.col(f"__o_{c}"), tt[c], F.col(c), ti[c]).alias(f"{c}_equal")
                                for c in cols])


def q_sync_bool_coerce(spark, sf_dir):
    _, i = _sync(spark, sf_dir)
    return i.select(SYNC_KEY, coerce_bool(F.col("flag"), T.StringType()).alias("flag"))


def q_sync_json_encode(spark, sf_dir):
    _, i = _sync(spark, sf_dir)
    nested = i.select(SYNC_KEY, F.struct("status", "price", "priority").alias("record"))
    return json_encoded(nested, ["record"])


def q_classify_changes(spark, sf_dir):
    t, i = _sync(spark, sf_dir)
    return classify_changes(t, i, SYNC_KEY, SYNC_COL)


def q_cell_diff(spark, sf_dir):
    t, i = _sync(spark, sf_dir)
    return cell_diff(t, i, SYNC_KEY, SYNC_COL)


def q_sync_upsert(spark, sf_dir):
    t, i = _sync(spark, sf_dir)
    return apply_upsert(t, i, SYNC_KEY, SYNC_AS_OF, SYNC_COL)


def q_sync_summary(spark, sf_dir):
    t, i = _sync(spark, sf_dir)
    return upsert_summary(classify_changes(t, i, SYNC_KEY, SYNC_COL))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items())
    if name.startswith("q_") and callable(fn)
}
