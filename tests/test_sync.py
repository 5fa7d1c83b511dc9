"""Upsert: equality rules, classification, idempotence, schema evolution."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.operators.sync import (
    apply_upsert,
    classify_changes,
    evolve_schema,
    infer_sync_schema,
    upsert_rows,
    upsert_summary,
    values_equal,
)
from quillmart.plans.upsert import sync_table
from quillmart.session import scratch_dir
from quillmart.sources.versions import SnapshotTable

AS_OF = dt.datetime(2020, 1, 1)


def _eq(spark, a, at, b, bt):
    df = spark.createDataFrame([(a, b)], T.StructType([T.StructField("a", at), T.StructField("b", bt)]))
    return df.select(values_equal(F.col("a"), at, F.col("b"), bt)).first()[0]


S, D, B, L = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()


@pytest.mark.parametrize("a,at,b,bt,want", [
    ("12", S, "12.0", S, True),            # numeric text
    ("1", S, True, B, True),               # bool as 1
    ("TRUE", S, True, B, True),            # bool text any case
    ("false", S, "0", S, True),
    ('{"a": 1, "b": 2}', S, '{"b":2,"a":1}', S, True),   # JSON key order
    ('[1, 2]', S, '[2, 1]', S, False),
    ('{bad', S, '{bad', S, True),          # unparsable JSON: raw text
    ("1_000", S, 1000.0, D, True),
    ("1d", S, 1.0, D, False),              # not a number for a strict parser
    ("abc", S, "abc", S, True),
    ("abc", S, "ABC", S, False),
    (None, S, None, D, True),
    (None, S, "x", S, False),
    (5, L, "x", S, False),
    (float("nan"), D, float("nan"), D, True),   # deliberate: null-safe NaN
])
def test_values_equal_rules(spark, a, at, b, bt, want):
    assert _eq(spark, a, at, b, bt) is want


def _target(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0, True, AS_OF - dt.timedelta(days=9)), (2, "b", 2.0, False, AS_OF - dt.timedelta(days=9)),
         (3, "c", 3.0, True, AS_OF - dt.timedelta(days=9))],
        "k long, s string, x double, f boolean, _synced_at timestamp_ntz")


def _incoming(spark):
    return spark.createDataFrame(
        [(1, "a", "1.0", "TRUE", None), (2, "B", "2", "false", "new"), (4, "d", "4", "true", None)],
        "k long, s string, x string, f string, extra string")



def test_infer_and_evolve(spark):
    inc = _incoming(spark)
    assert dict(infer_sync_schema(inc)) == {"k": "INTEGER", "s": "STRING", "x": "STRING", "f": "STRING",
                                            "extra": "STRING", "_synced_at": "TIMESTAMP"}
    ev = evolve_schema(_target(spark), inc)
    assert ev.columns == ["k", "s", "x", "f", "_synced_at", "extra"]
    assert ev.filter(F.col("extra").isNotNull()).count() == 0
    created = evolve_schema(None, inc)
    assert created.count() == 0 and "_synced_at" in created.columns


def test_classify_and_apply(spark):
    t, i = _target(spark), _incoming(spark)
    got = {r.k: (r.action, r.changed_columns) for r in classify_changes(t, i, "k").collect()}
    assert got == {1: ("unchanged", None), 2: ("update", "s,extra"), 3: ("keep", None), 4: ("insert", None)}
    new = {r.k: r for r in apply_upsert(t, i, "k", AS_OF).collect()}
    assert new[1]._synced_at == AS_OF - dt.timedelta(days=9)          # unchanged keeps its stamp
    assert (new[2].s, new[2].x, new[2].extra, new[2]._synced_at) == ("B", 2.0, "new", AS_OF)
    assert new[2].f is False                                             # only changed columns overwritten
    assert (new[4].f, new[4].x, new[4]._synced_at) == (True, 4.0, AS_OF)  # inserts coerced to stored types
    assert new[3].s == "c"


def test_upsert_is_idempotent(spark):
    t, i = _target(spark), _incoming(spark)
    once = apply_upsert(t, i, "k", AS_OF)
    once = spark.createDataFrame(once.collect(), once.schema)
    later = AS_OF + dt.timedelta(days=1)
    twice = apply_upsert(once, i, "k", later)
    counts = {r.action: r.n for r in upsert_summary(classify_changes(once, i, "k")).collect()}
    assert counts.get("insert", 0) == 0 and counts.get("update", 0) == 0
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_duplicate_or_null_keys_rejected(spark):
    for rows in ([(1, "a"), (1, "b")], [(None, "a")]):
        bad = spark.createDataFrame(rows, "k long, s string")
        with pytest.raises(PySparkException, match="must be unique"):
            upsert_rows(None, bad, "k", AS_OF, validate=True).collect()


def test_empty_incoming_keeps_target(spark):
    t = _target(spark)
    empty = spark.createDataFrame([], "k long, s string")
    new = apply_upsert(t, empty, "k", AS_OF)
    assert sorted(map(tuple, new.collect())) == sorted(map(tuple, t.collect()))


def test_duplicate_incoming_deduped_by_order(spark):
    base = scratch_dir(spark, "dedupe")
    sync_table(spark, _target(spark), "k", base, AS_OF)
    inc = spark.createDataFrame(
        [(2, "old", "2", "false", None, 1), (2, "newest", "2", "false", None, 2)],
        "k long, s string, x string, f string, extra string, ver int")
    assert sync_table(spark, inc, "k", base, AS_OF, dedupe_order=["ver"]) == {"update": 1, "keep": 2}
    assert SnapshotTable(spark, base).current().filter("k = 2").first().s == "newest"
