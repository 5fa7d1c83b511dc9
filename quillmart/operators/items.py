"""Current work items enriched with fields, people, projects and companies.

Grain of the result: (item, project, matching company row).  The job gets
there with fourteen left joins and a DISTINCT over 39 columns (HTML bodies
included).  Here every join side is made unique on its join key first, with
narrow dedupes, so the wide DISTINCT is never needed:

* items, people, projects, positions: newest version per key (one row per key);
* attribute values: one-pass pivot, one row per item;
* item -> project: distinct (item, resolved project id, project name) -- the
  resolved id is NULL when the project is unknown, so two unknown projects of
  one item collapse exactly as the job's DISTINCT collapses them;
* companies: distinct on the company columns the caller keeps.

Wide item rows (HTML and text bodies) shuffle once, in the version window on
the item id key.  Every dimension is joined on a narrow (id, foreign keys)
frame and rejoined on that key, so the wide rows keep the window's
partitioning; fan-out (projects, companies, worker directory) happens on the
narrow side, and wide rows multiply only in the last join.  Items with very many
links are split there (``hot_items``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.operators.attributes import WAREHOUSE_FIELDS, attribute_pivot
from quillmart.operators.companies import WAREHOUSE_DEAL_STAGES, WAREHOUSE_EXCLUDED_DEAL_TYPES
from quillmart.operators.companies import engaged_companies
from quillmart.operators.metrics import completion_ids, due_instants
from quillmart.operators.staging import (
    WAREHOUSE_FIELD_VALUE,
    WAREHOUSE_PAY_RATE,
    WAREHOUSE_PROJECT,
    WAREHOUSE_TASK,
    WAREHOUSE_TASK_PROJECT,
    WAREHOUSE_USER,
    stage,
    version_order,
)
from quillmart.operators.versions import latest_version


@dataclass
class Sources:
    """Raw source frames of the job (any layout; see ``Layouts``)."""
    task: DataFrame
    task_project: DataFrame
    project: DataFrame
    user: DataFrame
    field_value: DataFrame
    pay_rate: DataFrame
    workers: DataFrame
    company: DataFrame
    deal_company: DataFrame
    deal: DataFrame
    owner: DataFrame


@dataclass
class Layouts:
    task: dict = field(default_factory=lambda: dict(WAREHOUSE_TASK))
    task_project: dict = field(default_factory=lambda: dict(WAREHOUSE_TASK_PROJECT))
    project: dict = field(default_factory=lambda: dict(WAREHOUSE_PROJECT))
    user: dict = field(default_factory=lambda: dict(WAREHOUSE_USER))
    field_value: dict = field(default_factory=lambda: dict(WAREHOUSE_FIELD_VALUE))
    pay_rate: dict = field(default_factory=lambda: dict(WAREHOUSE_PAY_RATE))


@dataclass
class Params:
    """Clock, zones and business constants.  ``as_of`` is a UTC instant
    (``datetime``); ``today`` is the reporting-zone date used for company
    lifecycles (derived from ``as_of`` when None)."""
    as_of: object
    today: object = None
    stages: Sequence[str] = WAREHOUSE_DEAL_STAGES
    excluded_types: Sequence[str] = WAREHOUSE_EXCLUDED_DEAL_TYPES
    fields: Sequence[tuple[str, str]] = WAREHOUSE_FIELDS
    source_zone: str = "UTC"
    due_zone: str = "America/New_York"
    strict_parse: bool = True
    #: Project links that one task joins to one item's wide row, at most.
    hot_item_rows: int = 200_000
    layouts: Layouts = field(default_factory=Layouts)

    def today_col(self):
        from quillmart.functions.timeutil import today_in
        if self.today is not None:
            return F.lit(self.today).cast("date")
        return today_in(F.lit(self.as_of).cast("timestamp_ntz"), self.due_zone)


ITEM_COLUMNS = [
    "task_id", "task_name", "task_is_deleted", "task_resource_type", "task_resource_subtype",
    "task_assignee_id", "task_assignee_name", "task_assignee_email", "task_assignee_position",
    "task_html_description", "task_text_description", "task_link",
    "task_created_at", "task_modified_at", "task_due_at", "task_due_date", "task_last_due_date",
    "task_original_due_date", "task_is_completed", "task_completed_by", "task_completed_by_name",
    "task_completed_at", "task_completion_id", "task_active_id",
    "project_id", "project_name", "company_id", "company_name", "company_status",
    "company_brand_director", "company_brand_manager",
]
FIELD_COLUMNS = [
    "cf_priority", "cf_effort_score", "cf_raw_original_due_date",
    "cf_raw_original_due_date_change_count", "cf_task_type_cswo_wp", "cf_task_type_cswo_crm",
    "cf_task_type_cswo_rca", "cf_task_source",
]
STG_COLUMNS = ITEM_COLUMNS + FIELD_COLUMNS
COMPANY_COLUMNS = ["company_id", "company_name", "company_status",
                   "company_brand_director", "company_brand_manager"]


def staged_items(src: Sources, p: Params) -> DataFrame:
    """All versions of items in the model vocabulary."""
    return stage(src.task, p.layouts.task)


ID_KEY = ["__id0", "__id1"]


def _with_id_key(df: DataFrame) -> DataFrame:
    """Add the item id as two never-NULL columns (coalesced id, id IS NULL).

    Equality on both is null-safe equality on the id, and -- unlike a ``<=>``
    join condition, whose key expressions Spark derives itself -- they are
    plain columns, so a partitioning on them survives into later joins.
    """
    dtype = df.schema["task_id"].dataType
    zero = F.lit("") if isinstance(dtype, T.StringType) else F.lit(0).cast(dtype)
    return df.withColumns({"__id0": F.coalesce(F.col("task_id"), zero),
                           "__id1": F.col("task_id").isNull()})


def current_items(src: Sources, p: Params, keep_id_key: bool = False) -> DataFrame:
    """Newest version per item, dropped when that version is deleted (or NULL).

    The deleted test runs *after* picking the newest version: a deleted newest
    version removes the item, never falling back to an older live version.
    The window partitions on the two-column id key (same groups as the id,
    NULL included), so the result can be joined back on it without a shuffle.
    """
    lay = p.layouts.task
    # The newest version is picked independently in the wide branch and in the
    # narrow (foreign key) branch of ``item_base``.  Ending the order with a
    # hash of the columns the narrow branch uses makes both picks agree on
    # those columns even when versions tie, so enrichment always matches the
    # row it is attached to.
    narrow = F.xxhash64("task_is_deleted", "task_assignee_id", "task_completed_by")
    out = (latest_version(_with_id_key(staged_items(src, p)), ID_KEY, version_order(lay) + [narrow])
           .filter(F.col("task_is_deleted") != F.lit(True)))
    return out if keep_id_key else out.drop(*ID_KEY)


def latest_users(src: Sources, p: Params) -> DataFrame:
    lay = p.layouts.user
    # Ending the order with both names settles ties between versions the same way
    # wherever users are read, and keeps both columns in the rows that are shuffled for
    # the window in every role, so that Spark makes that exchange once and reuses it.
    return (latest_version(stage(src.user, lay), ["user_id"], version_order(lay) + ["user_name", "user_email"])
            .select("user_id", "user_name", "user_email"))


def latest_pay_rate(src: Sources, p: Params) -> DataFrame:
    """Newest pay-rate row per worker email, all columns (the job's ``worker``)."""
    lay = p.layouts.pay_rate
    staged = stage(src.pay_rate, lay, keep_other=True)
    return latest_version(staged, ["worker_email"],
                          ["effective_from"] + (["_version"] if "_version" in lay else []))


def item_fields(src: Sources, p: Params) -> DataFrame:
    lay = p.layouts.field_value
    return attribute_pivot(stage(src.field_value, lay), "task_id", "field_id", "display_value",
                           version_order(lay), p.fields)


def item_projects(src: Sources, p: Params) -> DataFrame:
    """Distinct (task_id, project_id, project_name); project_id is the project
    side's id, NULL when the linked project is unknown.  Link deletion flags are
    not applied (the job stages them but never filters on them)."""
    links = stage(src.task_project, p.layouts.task_project).select("task_id", "project_id").distinct()
    lay = p.layouts.project
    projects = (latest_version(stage(src.project, lay), ["project_id"], version_order(lay))
                .select(F.col("project_id").alias("__pid"), "project_name"))
    return (links.join(projects, links["project_id"] == projects["__pid"], "left")
            .select("task_id", F.col("__pid").alias("project_id"), "project_name")
            .distinct())


#: Range over which rows without a foreign key are spread in a join that they can't match.
NULL_SPREAD = 1 << 16


def lookup_join(rows: DataFrame, dimension: DataFrame, key: str, dimension_key: str, spread: str) -> DataFrame:
    """Left join of ``rows`` to a dimension, both keys being equal; ``dimension_key`` goes.

    Rows whose key is NULL match nothing, and SQL's join would send all of them to one
    task.  They get a hash of ``spread`` for a key instead, and a flag that no row of the
    dimension has.
    """
    dtype = dimension.schema[dimension_key].dataType
    null = F.col(key).isNull()
    salt = F.pmod(F.xxhash64(spread), F.lit(NULL_SPREAD)).cast(dtype)
    left = rows.withColumns({"__lk": F.coalesce(F.col(key).cast(dtype), salt), "__ln": null})
    right = dimension.where(F.col(dimension_key).isNotNull()).withColumn("__rn", F.col(dimension_key).isNull())
    on = (left["__lk"] == right[dimension_key]) & (left["__ln"] == right["__rn"])
    return left.join(right, on, "left").drop("__lk", "__ln", "__rn", dimension_key)


def people_joins(rows: DataFrame, src: Sources, p: Params, workers: DataFrame | None) -> DataFrame:
    """Assignee name/email/position, completer name, optionally the worker
    directory (fan-out by email).  Both roles read one shuffle of the users."""
    users = latest_users(src, p)
    assignee = users.select(F.col("user_id").alias("__a_id"), F.col("user_name").alias("task_assignee_name"),
                            F.col("user_email").alias("task_assignee_email"))
    completer = users.select(F.col("user_id").alias("__c_id"),
                             F.col("user_name").alias("task_completed_by_name"))
    position = latest_pay_rate(src, p).select(F.col("worker_email").alias("__w_email"),
                                              F.col("position_title").alias("task_assignee_position"))
    out = lookup_join(rows, assignee, "task_assignee_id", "__a_id", "task_id")
    out = lookup_join(out, position, "task_assignee_email", "__w_email", "task_id")
    out = lookup_join(out, completer, "task_completed_by", "__c_id", "task_id")
    if workers is not None:
        from quillmart.plans.marts import worker_directory
        out = lookup_join(out, worker_directory(workers), "task_assignee_email", "__w_email", "task_id")
    return out


def _id_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the two-column id key (null-safe id equality).  ``left``
    carries the key columns, partitioned by the version window, so only the
    narrow right side is shuffled."""
    r = _with_id_key(right).drop("task_id").withColumnsRenamed({"__id0": "__r0", "__id1": "__r1"})
    cond = (left["__id0"] == r["__r0"]) & (left["__id1"] == r["__r1"])
    return left.join(r, cond, "left").drop("__r0", "__r1")


def hot_items(links: DataFrame, rows_per_item: int) -> DataFrame:
    """(task_id, slices) of the items with more than ``rows_per_item`` links, that many in a slice at most."""
    n = F.count(F.lit(1))
    return (links.where(F.col("task_id").isNotNull()).groupBy("task_id").agg(F.ceil(n / rows_per_item).cast("int").alias("slices"))
            .where(F.col("slices") > 1))


def _fan_out_join(left: DataFrame, right: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``_id_join`` of items to their fan-out rows; rows of ``hot`` items are dealt to slices.

    The items come out of a window, so Spark's own skew handling can't split this join,
    and one item's rows would all be made by one task.  A hot item is repeated once per
    slice, and its fan-out rows are dealt to the slices by a hash.  Everything else
    joins as before: the wide rows of other items are not shuffled again.  A marker row
    per hot item takes the hot ones out of the ordinary join.
    """
    if hot is None:
        return _id_join(left, right)
    marked = right.join(hot, "task_id", "left")
    marker = hot.select("task_id", F.lit(True).alias("__hot"))
    normal = marked.where(F.col("slices").isNull()).drop("slices").unionByName(marker, allowMissingColumns=True)
    ordinary = _id_join(left, normal).where(F.col("__hot").isNull()).drop("__hot")
    # Identical hashes aside, a slice may stay empty; inner join, as every hot item has fan-out rows.
    dealt = marked.where(F.col("slices").isNotNull()).withColumn("__slice", F.pmod(F.xxhash64(*right.columns), F.col("slices")).cast("int")).drop("slices")
    keys = _with_id_key(hot).drop("task_id").withColumnsRenamed({"__id0": "__h0", "__id1": "__h1"})
    copies = left.join(keys, (left["__id0"] == keys["__h0"]) & (left["__id1"] == keys["__h1"])).drop("__h0", "__h1")
    copies = copies.withColumn("__slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    r = _with_id_key(dealt).drop("task_id").withColumnsRenamed({"__id0": "__r0", "__id1": "__r1", "__slice": "__rs"})
    # The slice comes first among the keys of an exchange of its own, so copies leave the item's partition.
    copies = copies.repartition("__id0", "__id1", "__slice")
    on = (copies["__id0"] == r["__r0"]) & (copies["__id1"] == r["__r1"]) & (copies["__slice"] == r["__rs"])
    return ordinary.unionByName(copies.join(r, on).drop("__r0", "__r1", "__rs", "__slice"))


def item_base(src: Sources, p: Params, workers: DataFrame | None = None) -> DataFrame:
    """Current items with fields and people, partitioned by the item id.

    The wide item rows shuffle once: the version window.  Each dimension is
    joined to a *narrow* (task_id, foreign keys) frame, and the narrow result
    joins back on the two-column id key (null-safe id equality), which keeps
    that partitioning.  Joins that SQL makes on plain equality (fields,
    projects) drop NULL ids on the narrow side first, so they match exactly
    what ``=`` would; the people frame keeps them, so a NULL-id item still
    gets its names.
    """
    items = current_items(src, p, keep_id_key=True)
    people = people_joins(items.select("task_id", "task_assignee_id", "task_completed_by"), src, p, workers)
    people = people.drop("task_assignee_id", "task_completed_by")
    fields = item_fields(src, p).filter(F.col("task_id").isNotNull())
    return _id_join(_id_join(items, fields), people)


def hot_links(src: Sources, p: Params) -> DataFrame | None:
    """The items to split by their number of project links; None, and a plan without that branch, where there are none."""
    links = stage(src.task_project, p.layouts.task_project).select("task_id", "project_id")
    hot = hot_items(links, p.hot_item_rows)
    return None if hot.isEmpty() else hot


def item_rows(src: Sources, p: Params, companies: DataFrame | None = None,
              workers: DataFrame | None = None, base: DataFrame | None = None) -> DataFrame:
    """Current items with fields, people, projects and (optionally) companies
    and worker-directory names, before the due-date columns are derived.

    Projects and companies are joined narrow too (fan-out happens on the
    narrow side) and join back on the id.  ``base`` lets several outputs share
    one materialised ``item_base``.
    """
    base = base if base is not None else item_base(src, p, workers)
    projects = item_projects(src, p).filter(F.col("task_id").isNotNull())
    hot = hot_links(src, p)
    if companies is not None:
        projects = attach_companies(projects, companies)
    return _fan_out_join(base, projects, hot)


def item_core(src: Sources, p: Params, companies: DataFrame | None = None, workers: DataFrame | None = None,
              base: DataFrame | None = None, derived: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``item_rows`` plus UTC instants, last/original due dates and completion ids.

    What only an item's own columns decide is worked out before projects multiply its
    rows, and so is what ``derived`` adds to the rows it is given.
    """
    base = base if base is not None else item_base(src, p, workers)
    items = due_instants(base, p.source_zone, p.due_zone, p.strict_parse).select("*", *completion_ids())
    return item_rows(src, p, companies, workers, derived(items) if derived else items).drop(*ID_KEY)


def company_dimension(src: Sources, p: Params, columns: Sequence[str] = COMPANY_COLUMNS) -> DataFrame:
    """Engaged companies keyed by linked project id, distinct on ``columns``."""
    comp = engaged_companies(src.company, src.deal_company, src.deal, src.owner,
                             p.today_col(), p.stages, p.excluded_types)
    return comp.select("asana_project_id", *columns).distinct()


def company_representatives(companies: DataFrame, ignoring: Sequence[str], mark: str) -> DataFrame:
    """``companies`` with ``mark``: true in one row of each group of rows equal but for ``ignoring``."""
    same = [c for c in companies.columns if c not in ignoring]
    first = F.row_number().over(Window.partitionBy(*same).orderBy(*[F.col(c).asc_nulls_first() for c in ignoring])) == 1
    return companies.withColumn(mark, first)


def attach_companies(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Fan-out left join on the project id (as text) = linked project id."""
    return (rows.join(companies, F.col("project_id").cast("string") == F.col("asana_project_id"), "left")
            .drop("asana_project_id"))


def denormalize_items(src: Sources, p: Params) -> DataFrame:
    """The job's 39-column staging table; rows are unique by construction."""
    return item_core(src, p, company_dimension(src, p)).select(*STG_COLUMNS)
