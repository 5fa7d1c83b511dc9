"""Entity-attribute-value pivot in one pass.

The job reads the attribute table once per attribute (eight scans, eight
windows, eight joins).  Here it is one filtered scan and one aggregation:
``max_by(value, ordering)`` per attribute, where rows of other attributes have a
NULL ordering and are skipped.  The aggregation is partial (map-side), so a hot
entity reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.functions.scalars import as_col

# ---- fixed values: attribute ids the job pivots, and their output columns ----
WAREHOUSE_FIELDS = (
    ("1201734696096558", "cf_priority"),
    ("1208897357973093", "cf_effort_score"),
    ("1208644446938644", "cf_raw_original_due_date"),
    ("1208991348180673", "cf_raw_original_due_date_change_count"),
    ("1207209146861080", "cf_task_type_cswo_wp"),
    ("1208942402522699", "cf_task_type_cswo_crm"),
    ("1207160032209514", "cf_task_type_cswo_rca"),
    ("1208211917800354", "cf_task_source"),
)
# ------------------------------------------------------------------------------

# Binding used with the derived test tables (event types stand in for ids; three of them feed two columns).
FIXTURE_FIELDS = (
    ("click", "cf_priority"),
    ("error", "cf_effort_score"),
    ("signup", "cf_raw_original_due_date"),
    ("purchase", "cf_raw_original_due_date_change_count"),
    ("view", "cf_task_type_cswo_wp"),
    ("click", "cf_task_type_cswo_crm"),
    ("error", "cf_task_type_cswo_rca"),
    ("view", "cf_task_source"),
)


def attribute_pivot(eav: DataFrame, entity: str, attribute: str, value: str,
                    order_by: Sequence, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per entity having any listed attribute; one column per attribute.

    Each column holds the value of the newest row of that (entity, attribute)
    by ``order_by`` (descending, NULL versions last) -- NULL if the attribute is
    absent or its newest value is NULL.
    """
    ids = [a for a, _ in fields]
    # Ordering as a struct: a NULL version compares lowest, so it loses to any
    # dated version but the row still counts (plain max_by would skip it).
    ordering = F.struct(*[as_col(c) for c in order_by])
    aggs = [F.max_by(F.col(value), F.when(F.col(attribute) == F.lit(a), ordering)).alias(name)
            for a, name in fields]
    return (eav.filter(F.col(attribute).isin(ids))
            .groupBy(entity).agg(*aggs))
