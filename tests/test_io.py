import pytest

from paths import SF_SMALL
from quillmart.plans.registry import QUERIES, RUN_QUERY_TEXT, fixtures
from quillmart.session import scratch_dir
from quillmart.sources.query import run_query
from quillmart.sources.sink import SnapshotTable, read_mart, write_mart


def test_run_query_validation(spark, tmp_path):
    with pytest.raises(ValueError):
        run_query(spark)
    with pytest.raises(ValueError):
        run_query(spark, text="   ")
    p = tmp_path / "q.sql"
    p.write_text("SELECT 1 AS one")
    assert run_query(spark, path=str(p)).first().one == 1
    fx = fixtures(spark, SF_SMALL)
    assert run_query(spark, text=RUN_QUERY_TEXT, f_task=fx["f_task"]).count() > 0


def test_write_mart_roundtrip(spark):
    df = QUERIES["turnaround_hours"](spark, SF_SMALL).join(
        QUERIES["due_instants"](spark, SF_SMALL), "task_id")
    path = scratch_dir(spark, "t-mart")
    write_mart(df, path, "task_created_at", ["task_turn_around_time"], num_partitions=3)
    back = read_mart(spark, path)
    assert sorted(back.columns) == sorted(df.columns)
    assert back.count() == df.count()


def test_snapshot_table_versions(spark):
    base = scratch_dir(spark, "snap")
    t = SnapshotTable(spark, base)
    assert t.current() is None
    t.commit(spark.range(3))
    t.commit(spark.range(5))
    assert t.versions() == [1, 2]
    assert t.current().count() == 5


def test_run_query_named_args(spark):
    df = run_query(spark, text="SELECT id FROM range(10) WHERE id >= :lo", args={"lo": 7})
    assert sorted(r.id for r in df.collect()) == [7, 8, 9]


def test_write_mart_splits_a_hot_day(spark):
    import glob
    import os

    from pyspark.sql import functions as F
    # 40% of the rows share one day and identical clustering values
    df = spark.range(20000).select(
        F.col("id"),
        F.when(F.col("id") % 5 < 2, F.lit("2000-01-01"))
        .otherwise(F.date_format(F.date_add(F.lit("2000-01-02"), (F.col("id") % 50).cast("int")), "yyyy-MM-dd"))
        .cast("timestamp_ntz").alias("created"),
        F.lit("same").alias("c"))
    path = scratch_dir(spark, "hot-day")
    write_mart(df, path, "created", ["c"], num_partitions=4)
    hot = glob.glob(os.path.join(path.replace("file:", ""), "__day=2000-01-01", "*.parquet"))
    assert len(hot) > 1
    assert read_mart(spark, path).count() == 20000


def test_write_mart_keeps_its_number_of_ranges(spark):
    from pyspark.sql import functions as F
    df = spark.range(400).select("id", F.lit("2000-01-01").cast("timestamp_ntz").alias("created"), F.lit("same").alias("c"))
    path = scratch_dir(spark, "ranges")
    write_mart(df, path, "created", ["c"], row_columns=["id"])
    back = read_mart(spark, path)
    # Small ranges are not merged, and rows that differ in row_columns alone are spread.
    assert len(back.inputFiles()) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert back.count() == 400


def test_publish_mart_versions(spark):
    from pyspark.sql import functions as F

    from quillmart.sources.sink import publish_mart
    base = scratch_dir(spark, "pub")
    df = spark.range(10).select("id", F.lit("2000-01-01").cast("timestamp_ntz").alias("t"))
    p1 = publish_mart(df, base, "t", ["id"], num_partitions=2)
    p2 = publish_mart(df.filter("id < 4"), base, "t", ["id"], num_partitions=2)
    assert p1 != p2 and SnapshotTable(spark, base).versions() == [1, 2]
    assert read_mart(spark, base).count() == 4
