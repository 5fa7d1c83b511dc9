import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def clash():
    """Adds columns with names that operators use themselves."""
    def add(df):
        names = ["id", "th", "key", "score", "component", "length", "spans", "n", "label", "vector", "marks", "fp", "row", "u", "v", "text_", "k", "i", "conv", "place", "x", "event", "entity"]
        have = {c.lower() for c in df.columns}
        return df.select("*", *[F.lit("x").alias(n) for n in names if n not in have])
    return add
