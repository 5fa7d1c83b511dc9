"""The two published marts.

Both are the staging rows joined to the workers directory plus SLA metrics.
The job applies DISTINCT over ~50 columns; that is exact here without the wide
DISTINCT because the staging rows are unique and the workers side is reduced
to distinct (email, manager, director) first -- the only columns the mart takes
from it.  ``assume_unique_stg=False`` keeps a DISTINCT for arbitrary inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.functions.scalars import json_first_scalar
from quillmart.operators.items import (
    COMPANY_COLUMNS,
    FIELD_COLUMNS,
    Params,
    Sources,
    company_dimension,
    item_core,
)
from quillmart.operators.metrics import sla_flags, sla_metrics, status_flags

HEAD = [
    "task_id", "task_name", "task_is_deleted", "task_resource_type", "task_resource_subtype",
    "task_assignee_id", "task_assignee_name", "task_assignee_email", "task_assignee_position",
    "task_html_description", "task_text_description", "task_link",
    "task_created_at", "task_modified_at", "task_due_at", "task_due_date", "task_last_due_date",
    "task_original_due_date",
]
METRICS = [
    "task_turn_around_time", "task_completion_from_original_due_date_time",
    "task_completion_from_original_due_date_days",
    "task_is_completed_before_original_due_date", "task_is_completed_after_original_due_date",
    "task_is_completed_before_last_due_date", "task_is_completed_after_last_due_date",
    "task_completed_outside_schedule", "task_completed_on_time",
]
ITEM_MART_COLUMNS = (HEAD + ["task_is_completed", "task_is_active", "task_completed_by",
                             "task_completed_by_name", "task_completed_at", "task_completion_id",
                             "task_active_id"] + METRICS
                     + ["project_id", "project_name"] + COMPANY_COLUMNS
                     + ["airtable_manager", "airtable_director"] + FIELD_COLUMNS)
BRAND_COLUMNS = ["company_brand_director", "company_brand_manager"]
ADHERENCE_MART_COLUMNS = [c for c in ITEM_MART_COLUMNS if c not in BRAND_COLUMNS]

# Partition and clustering specs of the two marts.
ITEM_MART_CLUSTER = ["cf_priority", "cf_effort_score", "cf_task_source", "task_completion_id"]
ADHERENCE_MART_CLUSTER = ["airtable_director", "airtable_manager", "task_completion_id"]
PARTITION_SOURCE = "task_created_at"
# What tells the rows of one item apart, and the items.
MART_ROW = ["task_id", "project_id", "project_name", "company_id", "airtable_manager", "airtable_director"]


def worker_directory(workers: DataFrame) -> DataFrame:
    """Distinct (email, first manager, first director) from the directory."""
    return (workers.select(F.col("work_email_address_copy").alias("__w_email"),
                           json_first_scalar("manager_name").alias("airtable_manager"),
                           json_first_scalar("director_name").alias("airtable_director"))
            .distinct())


def _derived(rows: DataFrame, as_of) -> DataFrame:
    """``rows`` with SLA metrics and flags, which only an item's own columns decide."""
    # status_flags reuse the name task_is_completed for the id-or-NULL flag.
    return rows.select(*[c for c in rows.columns if c != "task_is_completed"],
                       *status_flags(), *sla_metrics(as_of), *sla_flags())


def _metrics(rows: DataFrame, as_of, columns: list[str]) -> DataFrame:
    return _derived(rows, as_of).select(*columns)


def _mart(stg: DataFrame, workers: DataFrame, as_of, columns: list[str],
          assume_unique_stg: bool) -> DataFrame:
    joined = stg.join(worker_directory(workers),
                      F.col("task_assignee_email") == F.col("__w_email"), "left")
    out = _metrics(joined, as_of, columns)
    return out if assume_unique_stg else out.distinct()


def item_mart(stg: DataFrame, workers: DataFrame, as_of, assume_unique_stg: bool = False) -> DataFrame:
    """51-column item mart."""
    return _mart(stg, workers, as_of, ITEM_MART_COLUMNS, assume_unique_stg)


def adherence_mart(stg: DataFrame, workers: DataFrame, as_of, assume_unique_stg: bool = False) -> DataFrame:
    """49 columns: the item mart without the two brand-owner names.

    Dropping those columns can make rows equal, so for an arbitrary staging
    input this keeps a DISTINCT; ``build_marts`` avoids it by joining a company
    dimension that is already distinct without them.
    """
    return _mart(stg, workers, as_of, ADHERENCE_MART_COLUMNS, assume_unique_stg)


def item_mart_frame(src: Sources, p: Params, base=None) -> DataFrame:
    """The item mart with no wide DISTINCT and one wide shuffle (see ``item_base``)."""
    companies = company_dimension(src, p, COMPANY_COLUMNS)
    return item_core(src, p, companies, src.workers, base, lambda items: _derived(items, p.as_of)).select(*ITEM_MART_COLUMNS)


def adherence_mart_frame(src: Sources, p: Params, base=None) -> DataFrame:
    """The adherence mart; its company dimension is distinct without the brand
    names, so no DISTINCT is needed after dropping them."""
    narrow_cols = [c for c in COMPANY_COLUMNS if c not in BRAND_COLUMNS]
    companies = company_dimension(src, p, narrow_cols)
    return item_core(src, p, companies, src.workers, base, lambda items: _derived(items, p.as_of)).select(*ADHERENCE_MART_COLUMNS)


def mart_frames(src: Sources, p: Params) -> tuple[DataFrame, DataFrame]:
    """Both marts (item, adherence)."""
    return item_mart_frame(src, p), adherence_mart_frame(src, p)
