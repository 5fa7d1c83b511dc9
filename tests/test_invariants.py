"""SURVEY §5 invariants and a brute-force model of the upsert equality rule."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paths import SF_SMALL
from quillmart.operators.sync import values_equal
from quillmart.plans.marts import ADHERENCE_MART_COLUMNS, BRAND_COLUMNS, ITEM_MART_COLUMNS
from quillmart.plans.registry import QUERIES

FLAG_COLUMNS = [
    "task_is_completed", "task_is_active", "task_completion_id", "task_active_id",
    "task_is_completed_before_original_due_date", "task_is_completed_after_original_due_date",
    "task_is_completed_before_last_due_date", "task_is_completed_after_last_due_date",
    "task_completed_outside_schedule", "task_completed_on_time",
]


def test_latest_version_one_row_per_key(spark):
    df = QUERIES["latest_version"](spark, SF_SMALL)
    assert df.count() == df.select("user_id").distinct().count()
    cur = QUERIES["current_items"](spark, SF_SMALL)
    assert cur.count() == cur.select("task_id").distinct().count()


def test_adherence_is_item_mart_minus_brand_columns(spark):
    assert ADHERENCE_MART_COLUMNS == [c for c in ITEM_MART_COLUMNS if c not in BRAND_COLUMNS]
    assert len(ITEM_MART_COLUMNS) == 51 and len(ADHERENCE_MART_COLUMNS) == 49
    assert QUERIES["adherence_mart"](spark, SF_SMALL).columns == ADHERENCE_MART_COLUMNS


def test_flags_are_id_or_null(spark):
    df = QUERIES["item_mart"](spark, SF_SMALL)
    bad = df.filter(F.exists(F.array(*[F.col(c) for c in FLAG_COLUMNS]),
                             lambda x: x.isNotNull() & (x != F.col("task_id"))))
    assert bad.count() == 0


def test_marts_rows_are_distinct(spark):
    for key in ("item_mart", "adherence_mart", "denormalized_items"):
        df = QUERIES[key](spark, SF_SMALL)
        assert df.count() == df.distinct().count(), key


def test_attribute_pivot_one_row_per_entity(spark):
    df = QUERIES["attribute_pivot"](spark, SF_SMALL)
    assert df.count() == df.select("task_id").distinct().count()


# ---- brute-force model of the equality rule -------------------------------------

def _py_number(s):
    import re
    pat = (r"(?i)^\s*[+-]?(?:(?:\d(?:_?\d)*)?\.\d(?:_?\d)*(?:e[+-]?\d(?:_?\d)*)?"
           r"|\d(?:_?\d)*\.?(?:e[+-]?\d(?:_?\d)*)?|inf(?:inity)?|nan)\s*$")
    return float(s.strip().replace("_", "")) if re.match(pat, s) else None


def _model(v):
    """Canonical form of one value under the documented rule (pure Python)."""
    if v is None:
        return None
    if isinstance(v, bool):
        return ("n", float(v))
    if isinstance(v, (int, float)):
        return ("n", float(v))
    low = v.lower()
    if low in ("true", "false"):
        return ("n", 1.0 if low == "true" else 0.0)
    if v.startswith(("{", "[")):
        try:
            return ("j", json.dumps(json.loads(v), sort_keys=True, separators=(",", ":")))
        except ValueError:
            pass
    n = _py_number(v)
    if n is not None:
        return ("n", n)
    return ("t", v)


def _model_equal(a, b):
    ca, cb = _model(a), _model(b)
    if ca is None or cb is None:
        return ca is None and cb is None
    if ca[0] == cb[0] == "n" and math.isnan(ca[1]) and math.isnan(cb[1]):
        return True
    return ca == cb


POOL = ["1", "1.0", "01", " 2 ", "2", "1e0", "true", "TRUE", "False", "0", "0.0", "-0", "abc", "ABC",
        "1_000", "1000", "1d", "inf", "nan", '{"a":1,"b":[1,2]}', '{"b":[1,2],"a":1}', '{"b":[2,1],"a":1}',
        "[1,2]", "[2,1]", "{bad", "", None]


def test_values_equal_matches_model(spark):
    rng = random.Random(7)
    pairs = [(rng.choice(POOL), rng.choice(POOL)) for _ in range(400)] + [(x, x) for x in POOL]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", values_equal(F.col("a"), T.StringType(), F.col("b"), T.StringType())
                    .alias("eq")).collect()
    for r in got:
        assert r.eq == _model_equal(r.a, r.b), (r.a, r.b)


@pytest.mark.parametrize("num", [0.0, 1.0, 2.5, 1000.0])
def test_values_equal_number_vs_text_model(spark, num):
    df = spark.createDataFrame([(num, s) for s in POOL], "a double, b string")
    for r in df.select("a", "b", values_equal(F.col("a"), T.DoubleType(), F.col("b"), T.StringType())
                       .alias("eq")).collect():
        assert r.eq == _model_equal(r.a, r.b), (r.a, r.b)


def test_every_registered_key_is_in_the_readme_inventory():
    import os

    from quillmart.plans.registry import QUERIES
    readme = open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")).read()
    inventory = readme.split("## Operator inventory")[1].split("###")[0]
    missing = [k for k in QUERIES if f"`{k}`" not in inventory]
    assert not missing, missing
