"""Run SQL text (given inline or read from a file) as a lazy DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Quoted text, quoted names and comments: a ``;`` in them parts no statements.
_QUOTED = r"(?s)'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/"


def read_query_text(spark: SparkSession, path: str) -> str:
    """Query text from a local path or any Hadoop-readable URI (small, one file)."""
    if "://" in path:
        rows = spark.read.text(path, wholetext=True).limit(2).collect()
        if len(rows) != 1:
            raise ValueError(f"{path} must name exactly one file")
        return rows[0][0]
    with open(path, encoding="utf-8") as fh:
        return fh.read()


def run_query(spark: SparkSession, text: str | None = None, path: str | None = None,
              args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """``spark.sql`` over ``text`` (preferred) or the text stored at ``path``.

    ``args`` are named parameters (``:name`` markers); ``frames`` bind
    ``{name}`` placeholders to DataFrames.  Raises ``ValueError`` if neither
    text nor path is given, or the text is blank.  A single query runs when an
    action does.  A script of several statements, parted by ``;``, runs as one
    compound block of Spark's SQL scripting, statement by statement at once; its
    last statement gives the result.
    """
    if not text:
        if not path:
            raise ValueError("either text or path must be provided")
        text = read_query_text(spark, path)
    if not text or not text.strip():
        raise ValueError("query text is empty")
    body = text.strip().rstrip(";").rstrip()
    if ";" in re.sub(_QUOTED, "", body) and not body[:5].upper() == "BEGIN":
        text = f"BEGIN\n{body};\nEND"
    if frames:
        return spark.sql(text, args, **frames)
    return spark.sql(text, args)
