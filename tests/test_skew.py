"""Hot items, NULL foreign keys, one shuffle of the users, and one row per company group."""

from collections import Counter

from pyspark.sql import functions as F

from paths import SF_SMALL
from quillmart.operators.items import (
    ID_KEY,
    _fan_out_join,
    _with_id_key,
    company_representatives,
    denormalize_items,
    hot_items,
    lookup_join,
)
from quillmart.plans.registry import QUERIES, fixtures, params, sources
from quillmart.session import scratch_dir


def test_a_hot_item_spreads_over_tasks(spark):
    items = spark.range(200).select(F.when(F.col("id") != 199, F.col("id")).alias("task_id"), F.repeat(F.lit("wide"), 50).alias("body"))
    links = spark.range(10_000).select(F.when(F.col("id") % 10 < 4, F.lit(7)).otherwise(F.col("id") % 150).cast("long").alias("task_id"), F.col("id").alias("project_id"))
    hot = hot_items(links, 1000)
    assert [(r.task_id, r.slices) for r in hot.collect()] == [(7, 5)]
    left = _with_id_key(items)
    plain, split = (_fan_out_join(left, links, h).drop(*ID_KEY) for h in (None, hot))
    assert sorted(plain.columns) == sorted(split.columns)
    assert plain.exceptAll(split.select(plain.columns)).count() == 0 and split.count() == plain.count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        share = {name: Counter(r.p for r in df.where("task_id = 7").select(F.spark_partition_id().alias("p")).collect())
                 for name, df in (("plain", plain), ("split", split))}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(share["plain"]) == 1 and len(share["split"]) > 1
    assert max(share["split"].values()) < 0.8 * sum(share["plain"].values())


def test_split_items_give_the_same_staging_table(spark):
    src, p = sources(fixtures(spark, SF_SMALL)), params()
    base = scratch_dir(spark, "plain-items")
    denormalize_items(src, p).write.parquet(base)
    p.hot_item_rows = 8  # many items are hot
    got, want = denormalize_items(src, p), spark.read.parquet(base)
    assert "__slice" in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_null_keys_spread(spark):
    for kind in ("long", "string"):
        rows = spark.range(9000).select(F.col("id").alias("task_id"), F.when(F.col("id") % 3 != 0, F.col("id") % 50).cast(kind).alias("who"))
        people = spark.range(40).select(F.col("id").cast(kind).alias("__a_id"), F.concat(F.lit("n"), "id").alias("name"))
        people = people.union(spark.sql(f"SELECT CAST(NULL AS {kind}), 'nobody'"))
        got = lookup_join(rows, people.hint("merge"), "who", "__a_id", "task_id")
        want = rows.join(people, rows["who"] == people["__a_id"], "left").drop("__a_id")
        assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == 9000
        spread = Counter(r.p for r in got.where("who IS NULL").select(F.spark_partition_id().alias("p")).collect())
        if len(spread) > 1:  # not coalesced
            assert max(spread.values()) < 0.5 * 3000


def test_both_roles_read_one_shuffle_of_the_users(spark):
    df = QUERIES["two_role_join"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.partition("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("customer.parquet") <= 4  # two branches of the users' union, once or twice by role before reuse


def test_one_representative_per_company_group(spark):
    rows = [("p", 1, "a", "x", "m1"), ("p", 1, "a", "y", "m2"), ("p", 1, "b", "x", None), ("q", 1, "a", None, None), ("q", 1, "a", "z", None)]
    df = spark.createDataFrame(rows, "link string, id int, name string, d string, m string")
    got = company_representatives(df, ["d", "m"], "__mark")
    assert {(r.link, r.id, r.name): r.d for r in got.where("__mark").collect()} == {("p", 1, "a"): "x", ("p", 1, "b"): "x", ("q", 1, "a"): None}
    assert got.count() == 5
