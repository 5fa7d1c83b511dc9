"""Code -> name lookups keyed by zero-padded numeric codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.functions.scalars import zero_pad

def code_table(df: DataFrame, code_col: str, name_col: str, width: int = 3) -> DataFrame:
    """(code, name) with the code rendered as zero-padded text."""
    return df.select(zero_pad(code_col, width).alias("code"), F.col(name_col).alias("name"))


def code_lookup(df: DataFrame, code_col: str, table: DataFrame, width: int = 3,
                code_alias: str = "code", name_alias: str = "name") -> DataFrame:
    """Add the padded code and its name (NULL when unknown) to every row."""
    t = table.select(F.col("code").alias(code_alias), F.col("name").alias(name_alias))
    keyed = df.withColumn(code_alias, zero_pad(code_col, width))
    return keyed.join(t, code_alias, "left")
