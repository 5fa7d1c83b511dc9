"""Newest row per key, and the full version rank.

``latest_version`` is ``row_number() = 1`` over a key window.  Spark plans it
with a *partial* ``WindowGroupLimit`` before the shuffle, so every map task
forwards at most one row per key: a key holding a third of all rows still
arrives at its reducer as one row per map task.

``version_rank`` numbers *every* version of a key.  A plain key window would
send all rows of a hot key to one task, so the ranking runs on a range
partitioning of (key, version): a hot key spans many partitions, a window over
(partition, key) numbers the rows of each range -- no group is larger than one
range partition -- and a per-partition offset table -- one row per partition, so
its size is bounded by the partition count and it is safe to broadcast -- lifts
the local numbers to the key's rank.  The range-partitioned rows are
checkpointed once so both passes see identical partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmart.functions.scalars import as_col
from quillmart.session import scratch_dir

_RN = "__rn"


def _order(order_by: Sequence) -> list[Column]:
    """Versions newest first; NULL versions sort last (as ``ORDER BY v DESC``)."""
    return [as_col(c).desc_nulls_last() for c in order_by]


def latest_version(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """Newest row per ``keys`` by ``order_by`` (descending, NULLs last).

    Put a tie-break column last in ``order_by``; without one, equal versions
    pick an arbitrary row.  A NULL key forms its own group, like SQL windows.
    """
    w = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*_order(order_by))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def version_rank(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                 rank_col: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_by DESC).

    Exact for every row, and no key's rows are collected into one task.
    """
    keys = list(keys)
    spark = df.sparkSession
    # A row's place of origin last in the range key splits versions that tie on
    # (key, order), fully identical rows included.  Tied rows get distinct
    # consecutive ranks in an arbitrary order, as in SQL.
    pid, at = "__pid", "__at"
    sort = [F.col(k).asc_nulls_first() for k in keys] + _order(order_by) + [F.col(at)]
    # The partition ids must be the same in both branches below (offsets and
    # local numbers).  Range bounds are sampled per exchange, so two exchanges
    # could disagree; the partitioned rows are therefore materialised once with
    # a reliable checkpoint in the shared checkpoint folder, which both
    # branches read (and which survives executor loss without re-sampling).
    scratch_dir(spark)  # ensures a checkpoint folder is configured
    ranged = (df.withColumn(at, F.monotonically_increasing_id())
              .repartitionByRange(*([num_partitions] if num_partitions else []), *sort)
              .withColumn(pid, F.spark_partition_id())
              .checkpoint(eager=True))
    own = Window.partitionBy(pid, *keys).orderBy(*_order(order_by), at)
    local = ranged.withColumn(rank_col, F.row_number().over(own).cast("bigint"))

    # One row per non-empty partition: its first key, its last key and how
    # many rows of the last key it holds, from narrow (partition, key) counts.
    key_struct = F.struct(*[F.col(k) for k in keys])
    counts = ranged.groupBy(F.col(pid), key_struct.alias("k")).count()
    edges = counts.groupBy(pid).agg(
        F.min("k").alias("first_key"),
        F.max(F.struct(F.col("k"), F.col("count").alias("c"))).alias("last"),
    )
    w_all = Window.orderBy(pid)
    w_key = Window.partitionBy("last.k").orderBy(pid).rowsBetween(Window.unboundedPreceding, 0)
    offsets = (edges
               .withColumn("prev_last", F.lag("last.k").over(w_all))
               .withColumn("cum", F.sum("last.c").over(w_key))
               .withColumn("prev_cum", F.lag("cum").over(w_all))
               .select(F.col(pid).alias("__opid"), F.col("first_key").alias("__okey"),
                       F.when(F.col("prev_last").eqNullSafe(F.col("first_key")), F.col("prev_cum"))
                       .otherwise(F.lit(0)).alias("__off")))
    joined = local.join(F.broadcast(offsets), F.col(pid) == F.col("__opid"), "left")
    lifted = F.col(rank_col) + F.when(key_struct.eqNullSafe(F.col("__okey")), F.col("__off")).otherwise(0)
    cols = [c for c in df.columns]
    return joined.select(*cols, lifted.cast("bigint").alias(rank_col))
