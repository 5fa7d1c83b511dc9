"""The job's source tables, bound by name.

A mapping names a catalog table, or a folder of Parquet files, for each of the
job's eleven sources; the columns are those of the ``WAREHOUSE_*`` layouts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import fields

from pyspark.sql import SparkSession

from quillmart.operators.items import Sources

SOURCE_NAMES = tuple(f.name for f in fields(Sources))


def bind_sources(spark: SparkSession, tables: Mapping[str, str]) -> Sources:
    """``Sources`` over the given tables; every source must be named."""
    missing, unknown = set(SOURCE_NAMES) - set(tables), set(tables) - set(SOURCE_NAMES)
    if missing or unknown:
        raise ValueError(f"sources without a table: {sorted(missing)}; unknown sources: {sorted(unknown)}")
    return Sources(**{n: spark.read.parquet(t) if "/" in t else spark.table(t) for n, t in tables.items()})
