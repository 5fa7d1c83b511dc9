"""NULL-sensitive filters and flags (three-valued logic kept on purpose)."""

import datetime as dt

from pyspark.sql import functions as F

from quillmart.operators.attributes import attribute_pivot
from quillmart.operators.companies import lifecycle, qualifying_deals
from quillmart.operators.metrics import completion_ids, sla_flags, status_flags


def test_not_true_and_is_false_drop_null(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, d boolean")
    assert [r.id for r in df.filter(F.col("d") != F.lit(True)).collect()] == [2]
    assert [r.id for r in df.filter(F.col("d") == F.lit(False)).collect()] == [2]


def test_qualifying_deals_null_type_dropped(spark):
    df = spark.createDataFrame(
        [(1, "F", "x", dt.datetime(2000, 1, 1), False), (2, "F", None, dt.datetime(2000, 1, 1), False),
         (3, "F", "dsp", dt.datetime(2000, 1, 1), False), (4, "F", "x", None, False),
         (5, "F", "x", dt.datetime(2000, 1, 1), None), (6, "O", "x", dt.datetime(2000, 1, 1), False)],
        "deal_id int, deal_pipeline_stage_id string, property_dealtype string, "
        "property_effective_from timestamp_ntz, is_deleted boolean")
    out = qualifying_deals(df, ["F"], ["DSP"])
    assert [r.deal_id for r in out.collect()] == [1]


def test_flags_null_completion_counts_as_after(spark):
    df = spark.createDataFrame(
        [(1, True, dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 2), dt.datetime(2000, 1, 2)),
         (2, None, None, dt.datetime(2000, 1, 2), dt.datetime(2000, 1, 3)),
         (3, False, dt.datetime(2000, 1, 5), dt.datetime(2000, 1, 2), dt.datetime(2000, 1, 2))],
        "task_id int, task_is_completed boolean, task_completed_at timestamp_ntz, "
        "task_original_due_date timestamp_ntz, task_last_due_date timestamp_ntz")
    r = {x.task_id: x for x in df.select("task_id", *completion_ids(), *status_flags(), *sla_flags()).collect()}
    # NULL done: active id set (IF(done, NULL, id)) but is_active NULL (IF(done = FALSE, ...))
    assert r[2].task_active_id == 2 and r[2].task_is_active is None and r[2].task_completion_id is None
    # undated completion: "after" and "outside schedule", never "before"
    assert r[2].task_is_completed_after_original_due_date == 2
    assert r[2].task_is_completed_before_original_due_date is None
    assert r[2].task_completed_outside_schedule == 2
    # last != original -> on-time NULL even if early
    assert r[2].task_completed_on_time is None
    assert r[1].task_completed_on_time == 1 and r[1].task_is_completed_before_last_due_date == 1
    assert r[3].task_completed_outside_schedule == 3 and r[3].task_is_active == 3


def test_lifecycle_labels(spark):
    d = dt.date(2000, 6, 1)
    df = spark.createDataFrame(
        [(1, dt.date(2000, 1, 1), None), (2, dt.date(2000, 1, 1), dt.date(2000, 7, 1)),
         (3, dt.date(2000, 1, 1), dt.date(2000, 2, 1)), (4, dt.date(2000, 9, 1), None),
         (5, dt.date(2000, 6, 1), dt.date(2000, 5, 1))],
        "id int, f date, t date")
    got = {r.id: r.l for r in df.select("id", lifecycle("f", "t", F.lit(d)).alias("l")).collect()}
    assert got == {1: "active", 2: "cancelling", 3: "former", 4: "future", 5: None}


def test_attribute_pivot_null_newest_and_null_version(spark):
    df = spark.createDataFrame(
        [(1, "a", "old", 1), (1, "a", None, 2), (1, "b", "undated", None), (1, "b", "dated", 1),
         (2, "b", "only-undated", None), (3, "zz", "ignored", 1)],
        "e int, attr string, v string, ver int")
    out = attribute_pivot(df, "e", "attr", "v", ["ver"], [("a", "col_a"), ("b", "col_b"), ("c", "col_c")])
    got = {r.e: (r.col_a, r.col_b, r.col_c) for r in out.collect()}
    assert got == {1: (None, "dated", None), 2: (None, "only-undated", None)}


def test_tied_versions_enrichment_stays_consistent(spark):
    from quillmart.operators.items import item_base
    from quillmart.plans.registry import fixtures, params, sources
    from paths import SF_SMALL
    src = sources(fixtures(spark, SF_SMALL))
    # every version of an item now ties on (upserted_at, version_id)
    tied = src.task.withColumn("upserted_at", F.lit(dt.datetime(2000, 1, 1))).withColumn("version_id", F.lit(0))
    src.task = tied
    keyed = item_base(src, params(), None)
    users = src.user.select("gid", "name").groupBy("gid").agg(F.collect_set("name").alias("names"))
    bad = (keyed.join(users, keyed["task_assignee_id"] == users["gid"], "left")
           .filter(F.col("task_assignee_name").isNotNull() & ~F.array_contains("names", F.col("task_assignee_name"))))
    assert bad.count() == 0


def test_null_item_id_keeps_people_but_no_fields_or_projects(spark):
    from quillmart.operators.items import denormalize_items
    from quillmart.plans.registry import fixtures, params, sources
    from paths import SF_SMALL
    src = sources(fixtures(spark, SF_SMALL))
    # items 0..9 lose their id: they form one NULL-id group with one newest version
    src.task = src.task.withColumn("gid", F.when(F.col("gid") < 10, F.lit(None)).otherwise(F.col("gid")))
    stg = denormalize_items(src, params())
    nulls = stg.filter(F.col("task_id").isNull()).collect()
    assert len(nulls) <= 1
    if nulls:
        r = nulls[0]
        # plain-equality joins never match a NULL id ...
        assert r.project_id is None and r.cf_priority is None and r.company_id is None
        # ... but the people joins run on the row's own foreign keys
        if r.task_assignee_id is not None:
            assert r.task_assignee_name is not None
