"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quillmart.session import scratch_dir

#: Text bytes that a Python task holds at once; one longer text makes a slice of its own.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of ``column`` hold about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, int(batch.num_rows * limit / max(1, batch.column(column).nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder that the cluster names."""
    scratch_dir(df.sparkSession)  # sets the checkpoint folder where none is set
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: a checkpoint of smaller files."""
    path = scratch_dir(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = f"__{stem}_{uuid.uuid4().hex[:6]}"
    return name


def tokenizer_path(name: str) -> str:
    """A path as it is; the bare name of a public vocabulary file by its package."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)
