"""Latest version and full version rank, including hot keys and NULLs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillmart.operators.versions import latest_version, version_rank


def _key(t):
    return tuple((x is None, x if x is not None else 0) for x in t)


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_latest_version_nulls_last_and_tiebreak(spark):
    df = spark.createDataFrame(
        [(1, None, 5, "a"), (1, 10, 1, "b"), (1, 10, 2, "c"), (2, None, 1, "d"), (2, None, 2, "e"),
         (None, 1, 1, "f"), (None, 2, 1, "g")],
        "k int, v int, tb int, x string")
    out = latest_version(df, ["k"], ["v", "tb"])
    assert _rows(out, "k", "x") == sorted([(1, "c"), (2, "e"), (None, "g")], key=_key)


def test_latest_version_is_partial_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_version(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_version_rank_matches_window_on_hot_key(spark):
    # one key holds ~half the rows; four range partitions must split it
    base = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7919 % 1000).alias("v"),
        F.col("id").alias("tb"))
    base = base.union(spark.createDataFrame([(None, 3, 1), (None, None, 2)], "k long, v long, tb long"))
    got = version_rank(base, ["k"], ["v", "tb"], rank_col="rn", num_partitions=4)
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last(), F.col("tb").desc_nulls_last())
    want = base.withColumn("rn", F.row_number().over(w))
    assert _rows(got, "k", "v", "tb", "rn") == _rows(want, "k", "v", "tb", "rn")
    # the hot key really was spread over several partitions
    spread = (base.repartitionByRange(4, F.col("k").asc_nulls_first(), F.col("v").desc_nulls_last())
              .filter(F.col("k") == 7).select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread > 1


def test_version_rank_multi_column_key(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 1), (1, "b", 2), (2, "a", 9), (1, "a", 2)],
                               "a int, b string, v int")
    got = version_rank(df, ["a", "b"], ["v"], rank_col="rn", num_partitions=3)
    assert _rows(got, "a", "b", "v", "rn") == sorted(
        [(1, "a", 3, 1), (1, "a", 2, 2), (1, "a", 1, 3), (1, "b", 2, 1), (2, "a", 9, 1)], key=_key)


def test_version_rank_hot_key_with_tied_versions(spark):
    # a third of the rows share one key AND one version: the row hash must split them
    tied = spark.range(3000).select(F.lit(1).alias("k"), F.lit(5).alias("v"), F.col("id").alias("x"))
    rest = spark.range(6000).select((F.col("id") % 100 + 2).alias("k"), (F.col("id") % 7).alias("v"),
                                    F.col("id").alias("x"))
    df = tied.union(rest)
    got = version_rank(df, ["k"], ["v"], rank_col="rn", num_partitions=6)
    hot = got.filter(F.col("k") == 1)
    assert sorted(r.rn for r in hot.select("rn").collect()) == list(range(1, 3001))
    sizes = (df.repartitionByRange(6, F.col("k").asc_nulls_first(), F.col("v").desc_nulls_last(),
                                   F.xxhash64("k", "v", "x"))
             .filter(F.col("k") == 1).groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) > 1
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())
    want = df.withColumn("rn", F.row_number().over(w))
    # ranks per (k, v) group form the same multiset
    assert sorted(got.groupBy("k", "v").agg(F.min("rn"), F.max("rn")).collect()) == \
        sorted(want.groupBy("k", "v").agg(F.min("rn"), F.max("rn")).collect())


def test_version_rank_exact_when_range_bounds_are_sampled(spark):
    # large enough that range bounds come from a sample (not every row), so the
    # partitioning must be shared by both branches of the computation
    df = spark.range(0, 300000, 1, 6).select((F.col("id") % 7).alias("k"),
                                             (F.col("id") * 104729 % 300007).alias("v"))
    got = version_rank(df, ["k"], ["v"], rank_col="rn", num_partitions=5)
    w = Window.partitionBy("k").orderBy(F.col("v").desc())
    want = df.withColumn("rn", F.row_number().over(w))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == want.count()
