"""Due instants, turnaround/variance metrics and the id-or-NULL SLA flags.

The flags deliberately keep SQL's three-valued logic: a NULL comparison falls
to the ELSE branch, so an incomplete or undated item counts as "after" and
"outside schedule".  These look like bugs; they are the published semantics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmart.functions.timeutil import (
    REPORTING_ZONE,
    days_between,
    end_of_day,
    hours_between,
    local_to_utc,
    parse_local_timestamp,
)

def if_then_id(cond: Column, id_col: Column) -> Column:
    return F.when(cond, id_col)


def if_then_null(cond: Column, id_col: Column) -> Column:
    """IF(cond, NULL, id): NULL cond yields the id."""
    return F.when(cond, F.lit(None)).otherwise(id_col)


def due_instants(items: DataFrame, source_zone: str = "UTC", due_zone: str = REPORTING_ZONE,
                 strict_parse: bool = True) -> DataFrame:
    """Replace raw local times by UTC instants and add last/original due dates.

    ``task_due_at`` is read in ``source_zone`` while the *same* value feeds
    ``task_last_due_date`` read in ``due_zone`` (the job's two readings of one
    field).  Date-only due dates mean 23:59:59 in ``due_zone``.  The original
    due date is the parsed ``cf_raw_original_due_date`` text, else the last due
    date.
    """
    raw_due = F.coalesce(F.col("task_due_at").cast("timestamp_ntz"), end_of_day("task_due_date"))
    last_due = local_to_utc(raw_due, due_zone)
    parsed = parse_local_timestamp("cf_raw_original_due_date", due_zone, strict=strict_parse)
    return items.withColumns({
        "task_last_due_date": last_due,
        "task_original_due_date": F.coalesce(parsed, last_due),
        "task_created_at": local_to_utc("task_created_at", source_zone),
        "task_modified_at": local_to_utc("task_modified_at", source_zone),
        "task_due_at": local_to_utc("task_due_at", source_zone),
        "task_completed_at": local_to_utc("task_completed_at", source_zone),
    })


def completion_ids() -> list[Column]:
    """Staging flags: completion id and active id (NULL done -> active)."""
    tid = F.col("task_id")
    done = F.col("task_is_completed")
    return [if_then_id(done, tid).alias("task_completion_id"),
            if_then_null(done, tid).alias("task_active_id")]


def sla_metrics(as_of) -> list[Column]:
    """Turnaround hours (open items run to ``as_of``) and due-date variance."""
    now = F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of
    comp, orig = F.col("task_completed_at"), F.col("task_original_due_date")
    return [
        hours_between(F.coalesce(comp, now), F.col("task_created_at")).alias("task_turn_around_time"),
        hours_between(orig, comp).alias("task_completion_from_original_due_date_time"),
        days_between(orig, comp).alias("task_completion_from_original_due_date_days"),
    ]


def status_flags() -> list[Column]:
    """Mart flags: completed id, and active id only when done is FALSE (NULL -> NULL)."""
    tid, done = F.col("task_id"), F.col("task_is_completed")
    return [if_then_id(done, tid).alias("task_is_completed"),
            if_then_id(done == F.lit(False), tid).alias("task_is_active")]


def sla_flags() -> list[Column]:
    """Six due-date adherence flags, each the item id or NULL."""
    tid = F.col("task_id")
    comp, orig, last = F.col("task_completed_at"), F.col("task_original_due_date"), F.col("task_last_due_date")
    return [
        if_then_id(comp < orig, tid).alias("task_is_completed_before_original_due_date"),
        if_then_null(comp < orig, tid).alias("task_is_completed_after_original_due_date"),
        if_then_id(comp < last, tid).alias("task_is_completed_before_last_due_date"),
        if_then_null(comp < last, tid).alias("task_is_completed_after_last_due_date"),
        if_then_null(comp <= orig, tid).alias("task_completed_outside_schedule"),
        if_then_null(last != orig, if_then_id(comp <= orig, tid)).alias("task_completed_on_time"),
    ]
