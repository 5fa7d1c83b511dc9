"""Name -> parquet path catalog for the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")


class Catalog:
    """Reads ``<base>/<name>.parquet`` lazily; each name is read once per catalog."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]

    __getitem__ = table
