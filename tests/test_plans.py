"""Plan shape: semi-join, one attribute scan, no Python UDF, one wide shuffle."""

from paths import SF_SMALL
from quillmart.plans.registry import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_engaged_company_uses_semi_join(spark):
    plan = _plan(QUERIES["engaged_company"](spark, SF_SMALL))
    assert "LeftSemi" in plan


def test_attribute_pivot_single_scan_with_pushed_filter(spark):
    df = QUERIES["attribute_pivot"](spark, SF_SMALL)
    plan = _plan(df)
    assert plan.count("events.parquet") == 1
    assert "PushedFilters: [IsNotNull(event_type), In(event_type" in df._jdf.queryExecution().executedPlan().toString() \
        or "In(event_type" in plan


def test_marts_have_no_python_udf_and_no_wide_distinct(spark):
    for key in ("item_mart", "adherence_mart", "denormalized_items"):
        plan = _plan(QUERIES[key](spark, SF_SMALL))
        assert "Python" not in plan and "ArrowEval" not in plan
        # no aggregate keyed on the HTML body column (the job's wide DISTINCT)
        assert "keys=[task_id" not in plan or "task_html_description" not in plan.split("keys=[task_id")[1][:400]


def test_item_rows_shuffle_wide_columns_once(spark):
    df = QUERIES["item_mart"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges  # sanity
    formatted = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    blocks = formatted.split("\n\n")
    wide = [b for b in blocks if ") Exchange" in b.split("\n")[0] and "task_html_description" in b]
    # The wide rows shuffle exactly once: the version window on the id key;
    # every later join reuses that partitioning.
    assert len(wide) == 1, [b.split("\n")[-1][:120] for b in wide]
    assert "hashpartitioning(__id0" in wide[0]


def test_no_python_udf_in_any_query(spark):
    for key, fn in QUERIES.items():
        if key == "mart_write_readback":  # runs its write while it is built
            continue
        plan = _plan(fn(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in plan, (key, node)


def test_the_job_makes_wide_rows_once(spark):
    from quillmart.plans.job import both_mart_rows
    from quillmart.plans.registry import fixtures, params, sources
    df = both_mart_rows(sources(fixtures(spark, SF_SMALL)), params())
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    wide = [b for b in formatted.split("\n\n") if ") Exchange" in b.split("\n")[0] and "task_html_description" in b]
    assert len(wide) == 1 and not [b for b in formatted.split("\n\n") if ") Union" in b.split("\n")[0] and "task_html_description" in b]


def test_item_columns_are_derived_before_projects_multiply_rows(spark):
    # Time zones and due texts are read once per item: below the join to its projects, not above it.
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        for key in ("item_mart", "adherence_mart", "denormalized_items"):
            text = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
            above, joined, below = text.partition("Join LeftOuter")
            assert joined and "convert_timezone" not in above and "convert_timezone" in below, key
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
