"""One-call upsert of a frame into a keyed, bucketed table (batch form)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.operators.sync import ACTION, DIGEST, SYNCED_AT, align_names, evolve_schema, upsert_rows
from quillmart.operators.versions import latest_version
from quillmart.sources.versions import BUCKET, BUCKETS, CommitConflict, SnapshotTable, bucket_of

ACTIONS = ("insert", "update", "unchanged", "keep")
#: Times that an upsert starts over after another writer's commit.
ATTEMPTS = 10
# Both sides are dealt by bucket; with this off, that serves the join on (bucket, key) as it is.
_BY_BUCKET = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    held = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, held)


def sync_table(spark: SparkSession, incoming: DataFrame, key: str, base_path: str,
               as_of: dt.datetime | None = None, synced_col: str = SYNCED_AT,
               dedupe_order: Sequence | None = None, source: tuple[str, int] | None = None,
               buckets: int = BUCKETS) -> dict[str, int]:
    """Upsert ``incoming`` into the table at ``base_path``.

    Creates the table (with ``buckets`` buckets) when it does not exist, evolves its
    schema, inserts new keys, updates only changed columns of existing keys, and commits
    a new version in which only the buckets of the batch's keys are written anew: one
    join, with the key check and the counts in the same pass (the counts are an
    ``Observation`` of the written rows).  Rows are stored with a digest of their
    values, so that an unchanged row is known by one comparison.

    An empty batch only adds the columns that the table lacks, which writes a log entry
    and no data, and nothing at all if it lacks none.  If another writer commits
    meanwhile, the upsert starts over from what that one wrote.  ``source`` (a stream
    and its epoch) is kept with the version; an epoch that the table has is not applied
    again.  Returns the row counts per action.
    """
    table = SnapshotTable(spark, base_path)
    stamp = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if dedupe_order is not None:
        incoming = latest_version(incoming, [key], dedupe_order)
    for left in reversed(range(ATTEMPTS)):
        entry = table.entry()
        if source and entry and entry["streams"].get(source[0], -1) >= source[1]:
            return {}
        try:
            return _sync(table, entry, incoming, key, stamp, synced_col, source, buckets)
        except CommitConflict:
            if not left:
                raise
    raise AssertionError


def _sync(table: SnapshotTable, entry: dict | None, incoming: DataFrame, key: str, stamp: dt.datetime,
          synced_col: str, source: tuple[str, int] | None, buckets: int) -> dict[str, int]:
    spark = table.spark
    streams = dict((entry or {}).get("streams", {}))
    if source:
        streams[source[0]] = source[1]
    schema = T.StructType.fromJson(entry["schema"]) if entry else None
    stored = spark.createDataFrame([], schema) if entry else None
    evolved = evolve_schema(stored, align_names(incoming, stored), synced_col).schema
    if entry and entry["buckets"]:
        if entry["key"] != key:
            raise ValueError(f"the table's key is {entry['key']!r}, not {key!r}")
        buckets = entry["buckets"]
    split = bool(not entry or entry["buckets"])
    place = bucket_of(F.col(key).cast(evolved[key].dataType), buckets)
    touched = sorted(r[0] for r in align_names(incoming, stored).select(place.alias("b")).distinct().collect())
    if not touched:  # an empty batch
        if entry is None or evolved != schema:
            table.put(entry, schema=evolved.jsonValue(), streams=streams, parts=(entry or {}).get("parts", {}), key=key if split else None,
                      buckets=buckets if split else 0, digest=split, rows=0 if entry is None else entry["rows"])
        return {}
    if not split:  # a table written whole by ``commit``: it is dealt to buckets now
        touched = list(range(buckets))
    if entry is None:
        target = spark.createDataFrame([], T.StructType([*evolved, T.StructField(DIGEST, T.LongType())]))
    else:
        target = table.read(entry, touched if split else None, f"`{DIGEST}` long")
    with _setting(spark, _BY_BUCKET, "false"):
        rows = upsert_rows(target, incoming, key, stamp, synced_col, validate=True, bucketed=(place, len(touched)))
        seen = Observation()
        counted = rows.observe(seen, *[F.count_if(F.col(ACTION) == a).alias(a) for a in ACTIONS])
        name = table.attempt()
        counted.drop(ACTION).write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{table.base}/{name}")
    written = table.written_buckets(name)
    strange = set(written) - set(map(str, touched))
    if strange:
        table.discard(name)
        raise RuntimeError(f"the batch changed while it was read: buckets {sorted(strange)[:5]} were not in it before")
    counts = {a: int(seen.get[a]) for a in ACTIONS}
    before = entry["rows"] if entry and entry["rows"] is not None else counts["update"] + counts["unchanged"] + counts["keep"]
    counts["keep"] = before - counts["update"] - counts["unchanged"]
    others = {b: p for b, p in entry["parts"].items() if int(b) not in set(touched)} if entry and split else {}
    try:
        table.put(entry, parts={**others, **written}, schema=evolved.jsonValue(), rows=before + counts["insert"], key=key,
                  buckets=buckets, digest=True, streams=streams)
    except CommitConflict:
        table.discard(name)
        raise
    return {a: n for a, n in counts.items() if n}
