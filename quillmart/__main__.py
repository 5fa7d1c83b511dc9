"""``python -m quillmart --tables FILE --out DIR [--as-of ISO]``: run the daily job.

``--tables`` is a JSON file that names a table (or a Parquet folder) for each
source of the job; with ``--data`` the job runs over the work-tracking tables
derived from the raw test tables instead.  The session is the platform's: master,
memory and partition counts come from ``spark-submit`` or the environment.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from quillmart.operators.items import Params
from quillmart.plans.job import build_marts
from quillmart.session import apply_query_conf
from quillmart.sources.warehouse import bind_sources


def read_mapping(spark: SparkSession, path: str) -> dict[str, str]:
    """The JSON object in ``path``, read by Spark, so from any storage."""
    row = spark.read.option("multiLine", True).json(path).first()
    return json.loads(json.dumps(row.asDict())) if row else {}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="quillmart")
    given = ap.add_mutually_exclusive_group(required=True)
    given.add_argument("--tables", help="JSON file: source name -> table or Parquet folder")
    given.add_argument("--data", help="folder with the raw test tables")
    ap.add_argument("--out", required=True, help="folder for the marts")
    ap.add_argument("--as-of", default=None, help="UTC instant (ISO); default: now")
    ap.add_argument("--today", default=None, help="reporting-zone date for lifecycles (ISO)")
    a = ap.parse_args(argv)
    as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else \
        dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    today = dt.date.fromisoformat(a.today) if a.today else None
    spark = apply_query_conf(SparkSession.builder.appName("quillmart").getOrCreate())
    if a.tables:
        src, params = bind_sources(spark, read_mapping(spark, a.tables)), Params(as_of=as_of, today=today)
    else:
        from quillmart.plans import registry
        src, params = registry.sources(registry.fixtures(spark, a.data)), registry.params()
        params.as_of, params.today = as_of, today
    for name, path in build_marts(spark, src, params, a.out).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
