"""Every registered query against its DuckDB oracle on the smallest data set."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from quillmart.plans.registry import QUERIES
from quillmart.sources.catalog import RAW_TABLES

KEYS = sorted(QUERIES)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert len(got) == len(want)
    assert _sorted(got) == _sorted(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 51
    assert df.count() > 0
