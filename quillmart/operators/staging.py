"""Rename projections from source layouts into the model vocabulary.

A layout maps *model name -> source column*.  ``FIXTURE_*`` layouts describe the
derived test tables; ``WAREHOUSE_*`` layouts the work-tracking export the job
was written against (fixed values: the export's column names).  Model names
starting with ``_`` are bookkeeping (version order) and never reach a mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: model vocabulary of the source job, export column names ----
WAREHOUSE_TASK = {
    "_upserted_at": "WhenUpsertedIntoDataStore", "task_id": "Gid", "task_name": "Name",
    "task_is_deleted": "IsDeleted", "task_resource_type": "ResourceType",
    "task_resource_subtype": "ResourceSubtype", "task_assignee_id": "AssigneeUserGID",
    "task_html_description": "HtmlNotes", "task_text_description": "Notes",
    "task_link": "PermalinkUrl", "task_created_at": "CreatedAt", "task_modified_at": "ModifiedAt",
    "task_due_at": "DueAt", "task_due_date": "DueOn", "task_is_completed": "Completed",
    "task_completed_by": "CompletedByUserGID", "task_completed_at": "CompletedAt",
}
WAREHOUSE_TASK_PROJECT = {
    "_upserted_at": "WhenUpsertedIntoDataStore", "task_id": "TaskGID",
    "project_id": "ProjectGID", "task_project_is_deleted": "IsDeleted",
}
WAREHOUSE_PROJECT = {
    "_upserted_at": "WhenUpsertedIntoDataStore", "project_id": "Gid", "project_name": "Name",
    "project_html_description": "HtmlNotes", "project_description": "Notes", "project_link": "PermalinkUrl",
    "project_resource_type": "ResourceType", "project_is_deleted": "IsDeleted", "project_is_archived": "Archived",
    "project_is_completed": "Completed", "project_created_at": "CreatedAt", "project_start_at": "StartOn",
    "project_modified_at": "ModifiedAt", "project_due_date": "DueDate", "project_due_at": "DueOn",
    "project_completed_at": "CompletedAt", "project_completed_by_user_id": "CompletedByUserGID",
    "project_owner_user_id": "OwnerUserGID", "project_team_id": "TeamGID",
}
WAREHOUSE_USER = {
    "_upserted_at": "WhenUpsertedIntoDataStore", "user_id": "GID", "user_name": "Name",
    "user_email": "Email",
}
WAREHOUSE_FIELD_VALUE = {
    "_upserted_at": "WhenUpsertedIntoDataStore", "task_id": "TaskGID",
    "field_id": "CustomFieldGID", "display_value": "DisplayValue",
}
WAREHOUSE_PAY_RATE = {"worker_email": "worker_email", "effective_from": "effective_from",
                      "position_title": "position_title"}
# ------------------------------------------------------------------------------

FIXTURE_TASK = {
    "_upserted_at": "upserted_at", "_version": "version_id", "task_id": "gid", "task_name": "name",
    "task_is_deleted": "is_deleted", "task_resource_type": "resource_type",
    "task_resource_subtype": "resource_subtype", "task_assignee_id": "assignee_gid",
    "task_html_description": "html_notes", "task_text_description": "notes",
    "task_link": "permalink_url", "task_created_at": "created_at", "task_modified_at": "modified_at",
    "task_due_at": "due_at", "task_due_date": "due_on", "task_is_completed": "completed",
    "task_completed_by": "completed_by_gid", "task_completed_at": "completed_at",
}
FIXTURE_TASK_PROJECT = {
    "_upserted_at": "upserted_at", "task_id": "task_gid", "project_id": "project_gid",
    "task_project_is_deleted": "is_deleted",
}
FIXTURE_PROJECT = {"_upserted_at": "upserted_at", "_version": "version_id", "project_id": "gid",
                   "project_name": "name"}
FIXTURE_USER = {"_upserted_at": "upserted_at", "_version": "version_id", "user_id": "gid",
                "user_name": "name", "user_email": "email"}
FIXTURE_FIELD_VALUE = {"_upserted_at": "upserted_at", "_version": "version_id", "task_id": "task_gid",
                       "field_id": "field_gid", "display_value": "display_value"}
FIXTURE_PAY_RATE = {"worker_email": "worker_email", "effective_from": "effective_from",
                    "position_title": "position_title", "_version": "version_id"}

_DATE_COLUMNS = {"task_due_date", "project_due_date"}


def stage(df: DataFrame, layout: dict[str, str], keep_other: bool = False) -> DataFrame:
    """Select ``source AS model`` for every entry of ``layout``.

    ``task_due_date`` and ``project_due_date`` are cast to DATE.  With
    ``keep_other`` the remaining source columns are passed through unchanged.
    """
    cols = []
    for model, source in layout.items():
        c = F.col(source)
        if model in _DATE_COLUMNS:
            c = F.to_date(c)
        cols.append(c.alias(model))
    if keep_other:
        used = set(layout.values())
        cols += [F.col(c) for c in df.columns if c not in used and c not in layout]
    return df.select(*cols)


def version_order(layout: dict[str, str], primary: str = "_upserted_at") -> list[str]:
    """Newest-first order: the layout's version time, then its tie-break if any."""
    return [primary] + (["_version"] if "_version" in layout else [])
