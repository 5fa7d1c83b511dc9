"""Fixture coverage: the counts FIXTURES.md lists for sf0.001."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from quillmart.plans.registry import QUERIES


def test_staging_and_mart_counts(spark):
    stg = QUERIES["denormalized_items"](spark, SF_SMALL)
    assert stg.count() == 2975
    assert stg.select("task_id").distinct().count() == 296
    assert stg.filter(F.col("company_id").isNotNull()).count() == 122
    assert stg.filter(F.col("project_id").isNull()).count() == 209
    assert stg.filter(F.col("task_is_completed").isNull()).count() == 818
    assert stg.filter(F.coalesce("cf_task_type_cswo_wp", "cf_task_type_cswo_crm", "cf_task_type_cswo_rca").isNotNull()).count() > 0
    assert stg.filter(F.col("task_assignee_id").isNull()).count() == 57
    assert QUERIES["item_mart"](spark, SF_SMALL).count() == 3113


def test_company_counts(spark):
    comp = QUERIES["engaged_company"](spark, SF_SMALL)
    assert comp.count() == 9
    assert comp.filter(F.col("asana_project_id").isNotNull()).count() == 5
    assert comp.filter(F.col("company_brand_director").isNotNull()).count() == 5


def test_upsert_counts(spark):
    got = {r.action: r.n for r in QUERIES["sync_summary"](spark, SF_SMALL).collect()}
    assert got == {"insert": 300, "update": 425, "unchanged": 775, "keep": 300}
