"""Continuous upsert: apply each micro-batch of a stream to a keyed table.

The job's upsert is a batch call; on a stream it runs once per micro-batch in
``foreachBatch``.  Each batch becomes the table's next version, whose log entry says
how far each stream has come; a batch replayed after a failure finds its own epoch
there and is skipped, so replays never apply twice, and no other batch is ever skipped.

A stream is known by the id that Spark gives its query and keeps in the checkpoint:
the same over restarts, and another one after the checkpoint folder was reset, when
epochs begin at 0 again.  The sync time is the moment at which a batch is applied.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quillmart.operators.sync import SYNCED_AT
from quillmart.plans.upsert import sync_table
from quillmart.sources.files import read_text
from quillmart.sources.versions import SnapshotTable


def upsert_batch(table: SnapshotTable, batch: DataFrame, epoch_id: int, key: str, *, stream: str,
                 synced_col: str = SYNCED_AT, as_of: dt.datetime | None = None,
                 dedupe_order: Sequence | None = None) -> bool:
    """Apply one batch; returns False when this stream's epoch was already committed."""
    if table.streams().get(stream, -1) >= epoch_id:
        return False
    sync_table(table.spark, batch, key, table.base, as_of, synced_col, dedupe_order, source=(stream, epoch_id))
    return True


def start_sync_stream(stream: DataFrame, table: SnapshotTable, key: str, checkpoint_location: str,
                      synced_col: str = SYNCED_AT, trigger: dict | None = None,
                      dedupe_order: Sequence | None = None) -> StreamingQuery:
    """Start a streaming upsert of ``stream`` into ``table``."""
    def apply(df: DataFrame, epoch: int) -> None:
        # The query writes its id before its first batch.
        query = json.loads(read_text(table.spark, f"{checkpoint_location.rstrip('/')}/metadata"))["id"]
        upsert_batch(table, df, epoch, key, stream=query, synced_col=synced_col, dedupe_order=dedupe_order)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
