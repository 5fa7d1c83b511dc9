"""Daily job end to end, and the streaming upsert."""

import datetime as dt

from pyspark.sql import functions as F

from paths import SF_SMALL
from quillmart.plans.job import ADHERENCE_MART, ITEM_MART, build_marts
from quillmart.plans.registry import QUERIES, fixtures, params, sources
from quillmart.session import scratch_dir
from quillmart.sources.sink import SnapshotTable, read_mart
from quillmart.streaming.sync_stream import start_sync_stream, upsert_batch


def test_build_marts_writes_both(spark):
    out = build_marts(spark, sources(fixtures(spark, SF_SMALL)), params(), scratch_dir(spark, "job"),
                      num_partitions=4)
    item = read_mart(spark, out[ITEM_MART])
    adh = read_mart(spark, out[ADHERENCE_MART])
    assert len(item.columns) == 51 and len(adh.columns) == 49
    want = QUERIES["item_mart"](spark, SF_SMALL)
    assert item.count() == want.count()
    assert item.exceptAll(want.select(*item.columns)).count() == 0
    want_adh = QUERIES["adherence_mart"](spark, SF_SMALL)
    assert adh.count() == want_adh.count()
    assert adh.exceptAll(want_adh.select(*adh.columns)).count() == 0


def test_streaming_upsert_matches_batch(spark):
    fx = fixtures(spark, SF_SMALL)
    incoming = fx["f_sync_incoming"]
    src_dir = scratch_dir(spark, "stream-in")
    incoming.write.parquet(src_dir)
    table = SnapshotTable(spark, scratch_dir(spark, "stream-table"))
    stream = spark.readStream.schema(incoming.schema).parquet(src_dir)
    q = start_sync_stream(stream, table, "ref_id", scratch_dir(spark, "stream-ckpt"),
                          trigger={"availableNow": True})
    q.awaitTermination(300)
    got = table.current()
    assert got is not None
    assert got.count() == incoming.count()
    assert got.filter(F.col("_synced_at").isNull()).count() == 0
    # replaying an epoch that is already committed is a no-op
    stream, epoch = next(iter(table.streams().items()))
    assert upsert_batch(table, incoming, epoch, "ref_id", as_of=dt.datetime(2030, 1, 1), stream=stream) is False


def test_sync_table_twice_is_idempotent(spark):
    from quillmart.plans.upsert import sync_table
    fx = fixtures(spark, SF_SMALL)
    base = scratch_dir(spark, "sync-table")
    existing = fx["f_sync_existing"].withColumnRenamed("synced_at", "_synced_at")
    first = sync_table(spark, existing, "ref_id", base, as_of=dt.datetime(2001, 9, 1))
    assert first == {"insert": existing.count()}
    second = sync_table(spark, fx["f_sync_incoming"], "ref_id", base, as_of=dt.datetime(2002, 1, 1))
    assert second == {"insert": 300, "update": 425, "unchanged": 775, "keep": 300}
    third = sync_table(spark, fx["f_sync_incoming"], "ref_id", base, as_of=dt.datetime(2002, 2, 1))
    assert third.get("insert", 0) == 0 and third.get("update", 0) == 0
    t = SnapshotTable(spark, base)
    assert t.versions() == [1, 2, 3]
    assert t.current().exceptAll(t.current(2)).count() == 0
