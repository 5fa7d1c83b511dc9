"""Upsert equality by type, the same batch twice, and writes that must not lose data."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillmart.operators.sync import apply_upsert, classify_changes, values_equal
from quillmart.plans.upsert import sync_table
from quillmart.session import scratch_dir
from quillmart.sources.sink import SnapshotTable

AS_OF = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("a,b,want", [
    ("'{\"a\":1}'", "'{\"a\":1.0}'", False), ("'{\"a\":1.0}'", "'{\"a\":1.00}'", True),
    ("'{\"a\":\"1.0\"}'", "'{\"a\": \"1.0\"}'", True), ("9007199254740993L", "9007199254740992L", False),
    ("'9007199254740993'", "9007199254740993L", True), ("5", "5.0D", True), ("cast(1.50 as decimal(9,2))", "'1.5'", True),
    ("array(1,2)", "'[1, 2]'", True), ("array(1,2)", "'[2,1]'", False), ("named_struct('x',1,'y',null)", "'{\"y\":null,\"x\":1}'", True),
    ("timestamp '2024-01-01 10:00:00 UTC'", "timestamp_ntz '2024-01-01 10:00:00'", True), ("date '2024-01-01'", "'2024-01-01'", True),
    ("'1e400'", "'1e401'", True), ("true", "1", True), ("map('k',1)", "'{\"k\":1}'", True),
])
def test_equality(spark, a, b, want):
    df = spark.sql(f"SELECT {a} AS a, {b} AS b")
    types = [f.dataType for f in df.schema]
    assert df.select(values_equal(F.col("a"), types[0], F.col("b"), types[1])).first()[0] is want


def test_the_same_batch_twice_changes_nothing(spark):
    batch = spark.sql("""SELECT id AS k, array(id, 2) AS tags, named_struct('a', id, 'b', null) AS rec, map('m', 1.5D) AS m,
        timestamp '2024-01-01 10:00:00+03:00' AS zoned, timestamp_ntz '2024-01-01 10:00:00' AS plain, date '2024-01-01' AS day,
        9007199254740993 + id AS big, '{"r": 1.0}' AS js, cast(1.25 as decimal(9,2)) AS dec, id % 2 = 0 AS flag, cast('nan' as double) AS x
        FROM range(4)""")
    base = scratch_dir(spark, "twice")
    assert sync_table(spark, batch, "k", base, AS_OF) == {"insert": 4}
    assert sync_table(spark, batch, "k", base, AS_OF + dt.timedelta(days=1)) == {"unchanged": 4}
    changed = batch.withColumn("big", F.expr("if(k = 1, big + 1, big)"))
    assert sync_table(spark, changed, "k", base, AS_OF) == {"update": 1, "unchanged": 3}


def test_empty_batch_writes_only_new_columns(spark):
    base = scratch_dir(spark, "empty")
    batch = spark.createDataFrame([(1, "a")], "k long, s string")
    sync_table(spark, batch, "k", base, AS_OF)
    assert sync_table(spark, batch.limit(0), "k", base, AS_OF) == {}
    assert SnapshotTable(spark, base).versions() == [1]
    sync_table(spark, batch.limit(0).withColumn("extra", F.lit(1)), "k", base, AS_OF)
    assert SnapshotTable(spark, base).versions() == [1, 2] and SnapshotTable(spark, base).current().count() == 1


def test_keys_names_and_lossy_values(spark):
    target = spark.createDataFrame([(1, 5, None)], "k long, n int, _synced_at timestamp_ntz")
    with pytest.raises(ValueError, match="key 'k'"):
        apply_upsert(target, spark.createDataFrame([("01", 5)], "k string, n int"), "k", AS_OF)
    narrow = apply_upsert(target, spark.createDataFrame([(1, 6)], "k int, N long"), "k", AS_OF).first()
    assert (narrow.k, narrow.n) == (1, 6)
    for value, kind in ((5.7, "double"), ("x", "string"), (Decimal("5.70"), "decimal(9,2)"), (2**40, "long")):
        with pytest.raises(PySparkException, match="without loss"):
            apply_upsert(target, spark.createDataFrame([(1, value)], f"k long, n {kind}"), "k", AS_OF).collect()
    assert apply_upsert(target, spark.createDataFrame([(1, "6.0")], "k long, n string"), "k", AS_OF).first().n == 6


def test_duplicate_stored_keys_raise_in_the_same_pass(spark):
    base = scratch_dir(spark, "dup")
    SnapshotTable(spark, base).commit(spark.createDataFrame([(1, "a", None), (1, "b", None)], "k long, s string, _synced_at timestamp_ntz"))
    with pytest.raises(PySparkException, match="must be unique"):
        sync_table(spark, spark.createDataFrame([(2, "a")], "k long, s string"), "k", base, AS_OF)


def test_one_join_two_scans(spark):
    a, b = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    spark.createDataFrame([(1, "a", None)], "k long, s string, _synced_at timestamp_ntz").write.parquet(a)
    spark.createDataFrame([(1, "b")], "k long, s string").write.parquet(b)
    target, batch = spark.read.parquet(a), spark.read.parquet(b)
    for df in (apply_upsert(target, batch, "k", AS_OF), classify_changes(target, batch, "k")):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("Join") == 1 and plan.count("FileScan") == 2
