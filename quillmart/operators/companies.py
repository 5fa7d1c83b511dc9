"""Client companies with a qualifying deal (the job's company staging).

The job left-joins company -> deal links -> deals, filters the deal side to
non-NULL and takes DISTINCT: an existence test.  Here it is a semi-join on the
distinct company ids of qualifying links, so the large link table is reduced
map-side before any shuffle and never multiplies company rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmart.functions.scalars import as_col, full_name, url_id

# ---- fixed values: deal stages and excluded deal types of the source job ----
WAREHOUSE_DEAL_STAGES = ("closedwon", "164794937")
WAREHOUSE_EXCLUDED_DEAL_TYPES = ("DSP", "SELLER SUCCESS ACADEMY")
# ------------------------------------------------------------------------------


def qualifying_deals(deal: DataFrame, stages: Sequence[str], excluded_types: Sequence[str]) -> DataFrame:
    """Deals in ``stages`` whose upper-cased type is not excluded, dated, not deleted.

    NULL semantics as in SQL: a NULL type or NULL deleted flag drops the deal.
    """
    return deal.filter(
        F.col("deal_pipeline_stage_id").isin(list(stages))
        & ~F.upper(F.col("property_dealtype")).isin([t.upper() for t in excluded_types])
        & F.col("property_effective_from").isNotNull()
        & (F.col("is_deleted") != F.lit(True)))


def lifecycle(effective_from, effective_to, today) -> Column:
    """'active' | 'cancelling' | 'former' | 'future' | NULL (excluded).

    Dates compare at day precision; ``today`` is a DATE column.
    """
    f = F.to_date(as_col(effective_from))
    t = F.to_date(as_col(effective_to))
    d = as_col(today)
    return (F.when((f <= d) & t.isNull(), F.lit("active"))
            .when((f <= d) & (d <= t), F.lit("cancelling"))
            .when((f < d) & (t < d), F.lit("former"))
            .when(d < f, F.lit("future")))


def current_companies(company: DataFrame, today) -> DataFrame:
    """Companies with an id, not deleted (NULL flag drops), dated and in a lifecycle."""
    return (company
            .filter(F.col("id").isNotNull() & (F.col("is_deleted") == F.lit(False))
                    & F.col("property_effective_from").isNotNull())
            .withColumn("lifecycle", lifecycle("property_effective_from", "property_effective_to", today))
            .filter(F.col("lifecycle").isNotNull()))


def engaged_companies(company: DataFrame, deal_company: DataFrame, deal: DataFrame,
                      owner: DataFrame, today, stages: Sequence[str],
                      excluded_types: Sequence[str]) -> DataFrame:
    """Distinct engaged companies with linked project id and owner names (7 columns)."""
    deals = qualifying_deals(deal, stages, excluded_types).select("deal_id")
    engaged_ids = (deal_company.select("company_id", "deal_id")
                   .join(deals, "deal_id", "left_semi")
                   .select("company_id").distinct())
    comp = (current_companies(company, today)
            .join(engaged_ids, F.col("id") == F.col("company_id"), "left_semi"))
    people = owner.select("owner_id", full_name("first_name", "last_name").alias("owner_full_name"))
    director = people.select(F.col("owner_id").alias("__bd_id"),
                             F.col("owner_full_name").alias("company_brand_director"))
    manager = people.select(F.col("owner_id").alias("__bm_id"),
                            F.col("owner_full_name").alias("company_brand_manager"))
    return (comp
            .join(director, F.col("property_brand_director") == F.col("__bd_id"), "left")
            .join(manager, F.col("property_brand_manager") == F.col("__bm_id"), "left")
            .select(F.col("id").alias("company_id"),
                    F.col("property_name").alias("company_name"),
                    F.col("property_asana_project").alias("asana_project_link"),
                    url_id("property_asana_project").alias("asana_project_id"),
                    F.col("property_client_status").alias("company_status"),
                    "company_brand_director", "company_brand_manager")
            .distinct())
