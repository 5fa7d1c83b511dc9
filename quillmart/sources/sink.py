"""Partitioned mart writes.

``write_mart`` is the full-refresh, day-partitioned, clustered table of the job;
``publish_mart`` writes it as a new version (see ``versions``) so a failed run never
leaves a half-written or missing mart, and two runs at once never mix.
Rows are range-partitioned on (day, clustering columns, row hash) so one heavy
day -- even one heavy (day, cluster values) group -- is split across many
tasks instead of landing in one, and each task writes sorted
files whose row-group min/max statistics serve the clustering columns.

The last clustering column has a value of its own in almost every row, and sorting by
the ones before it spreads its values over all row groups.  Bloom filters per row group
make a look-up by it read only the row groups that may hold it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.sources.versions import SnapshotTable

__all__ = ["SnapshotTable", "publish_mart", "read_mart", "write_mart"]

DAY_COL = "__day"
# Filters grow with the values that a row group holds, from a few hundred bytes to 2 MB;
# of a fixed size they would outweigh the data of a small day.
BLOOM = {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(2 << 20)}
BLOOM_COLUMN = {"parquet.bloom.filter.enabled": "true", "parquet.bloom.filter.candidates.number": "13"}


def write_mart(df: DataFrame, path: str, partition_source: str, cluster: Sequence[str],
               num_partitions: int | None = None, max_records_per_file: int = 5_000_000,
               mode: str = "overwrite", point_columns: Sequence[str] | None = None,
               row_columns: Sequence[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` partitioned by ``DATE(partition_source)``.

    NULL days go to the default partition.  The derived day column is a
    folder name only; ``read_mart`` drops it.  ``point_columns`` (the last clustering
    column by default) get bloom filters.  ``row_columns`` tell apart the rows of a day
    that share their clustering values (all columns by default; fewer are hashed faster).
    """
    keyed = df.withColumn(DAY_COL, F.to_date(F.col(partition_source)))
    order = [F.col(DAY_COL)] + [F.col(c) for c in cluster]
    # A row hash last in the range key splits a (day, cluster values) group
    # that holds a large share of all rows; identical keys alone cannot be split.
    spread = F.xxhash64(*[F.col(c) for c in row_columns or df.columns])
    points = cluster[-1:] if point_columns is None else point_columns
    bloom = BLOOM | {f"{name}#{c}": value for c in points for name, value in BLOOM_COLUMN.items()}
    # A fixed number: adaptive execution would merge the ranges to about one a core, by their
    # shuffled size, and the few left over would make the cores wait for a second round.
    conf = df.sparkSession.conf
    ranges = num_partitions or int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                                   or conf.get("spark.sql.shuffle.partitions"))
    (keyed.repartitionByRange(ranges, *order, spread)
     .sortWithinPartitions(*order)
     .write.mode(mode)
     .option("maxRecordsPerFile", max_records_per_file).options(**bloom)
     .partitionBy(DAY_COL)
     .parquet(path))


def publish_mart(df: DataFrame, base: str, partition_source: str, cluster: Sequence[str],
                 num_partitions: int | None = None, row_columns: Sequence[str] | None = None) -> str:
    """Full refresh as a new version; returns the folder of its data.

    Readers (``read_mart``) switch to it only once it is complete, so a run
    that fails mid-write leaves the previous version in place -- the atomic
    replace the job's CREATE OR REPLACE TABLE gives.
    """
    table = SnapshotTable(df.sparkSession, base)
    name = table.attempt()
    write_mart(df, f"{table.base}/{name}", partition_source, cluster, num_partitions, mode="errorifexists",
               row_columns=row_columns)
    table.publish(name, df.schema)
    return f"{table.base}/{name}"


def read_mart(spark: SparkSession, path: str, days: tuple | None = None) -> DataFrame:
    """A mart written by ``write_mart`` (a folder) or ``publish_mart`` (its base:
    the newest version is read).

    ``days`` (first, last: dates or ISO texts, either may be None) reads only the
    folders of those days.
    """
    entry = SnapshotTable(spark, path).entry()
    mart = spark.read.parquet(f"{path.rstrip('/')}/{entry['parts']['all']}" if entry else path)
    for bound, keep in zip(days or (), (F.col(DAY_COL).__ge__, F.col(DAY_COL).__le__)):
        if bound is not None:
            mart = mart.where(keep(F.lit(str(bound)).cast("date")))
    return mart.drop(DAY_COL)
