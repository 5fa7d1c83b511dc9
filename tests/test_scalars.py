import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.functions.scalars import coerce_bool, full_name, json_first_scalar, url_id, zero_pad
from quillmart.functions.timeutil import days_between, hours_between, local_to_utc, parse_local_timestamp


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_url_id(spark):
    got = _one(spark, url_id("u"), [("https://a/0/12/list",), ("https://a/1/9/project/44",),
                                    ("https://x/none",), (None,), ("https://a/project/5\n",)], "u string")
    assert got == ["12", "44", None, None, None]


def test_full_name_null_propagates(spark):
    got = _one(spark, full_name("a", "b"), [("x", "y"), ("x", None)], "a string, b string")
    assert got == ["x y", None]


def test_json_first_scalar(spark):
    got = _one(spark, json_first_scalar("j"),
               [('["x"]',), ("[null]",), ("[]",), ('[{"a":1}]',), ("[[1]]",), ("[true]",), ("bad",), (None,)],
               "j string")
    assert got == ["x", None, None, None, None, "true", None, None]


def test_zero_pad_keeps_long_codes(spark):
    assert _one(spark, zero_pad("c"), [(7,), (1234,)], "c int") == ["007", "1234"]


def test_coerce_bool(spark):
    assert _one(spark, coerce_bool(F.col("s"), T.StringType()), [("TRUE",), ("false",), (None,)],
                "s string") == [True, False, None]
    assert _one(spark, coerce_bool(F.col("n"), T.IntegerType()), [(0,), (3,)], "n int") == [False, True]
    with pytest.raises(Exception):
        _one(spark, coerce_bool(F.col("s"), T.StringType()), [("yes",)], "s string")


def test_zone_conversion_and_dst(spark):
    rows = [(dt.datetime(1999, 1, 5, 23, 59, 59),), (dt.datetime(1999, 7, 5, 23, 59, 59),)]
    got = _one(spark, local_to_utc(F.col("t"), "America/New_York"), rows, "t timestamp_ntz")
    assert got == [dt.datetime(1999, 1, 6, 4, 59, 59), dt.datetime(1999, 7, 6, 3, 59, 59)]


def test_parse_local_strict_and_lenient(spark):
    df = spark.createDataFrame([("1/5/1999 3:4:5",), ("13/45/1999 1:1:1",)], "s string")
    lenient = [r[0] for r in df.select(parse_local_timestamp("s", "UTC", strict=False)).collect()]
    assert lenient == [dt.datetime(1999, 1, 5, 3, 4, 5), None]
    with pytest.raises(Exception):
        df.select(parse_local_timestamp("s", "UTC", strict=True)).collect()


def test_diffs_truncate_toward_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 1, 1, 1), dt.datetime(2000, 1, 3))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(hours_between("a", "b").alias("h"), days_between("a", "b").alias("d")).first()
    assert (r.h, r.d) == (-47, -1)


def test_local_time_in_dst_gap_moves_forward(spark):
    # 2:30 on the spring-forward day does not exist in New York; it is read as 3:30 EDT
    got = _one(spark, local_to_utc(F.col("t"), "America/New_York"),
               [(dt.datetime(1999, 4, 4, 2, 30),), (dt.datetime(1999, 10, 31, 1, 30),)], "t timestamp_ntz")
    assert got[0] == dt.datetime(1999, 4, 4, 7, 30)
    assert got[1] in (dt.datetime(1999, 10, 31, 5, 30), dt.datetime(1999, 10, 31, 6, 30))
