"""Streaming writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from alluvia.functions.audit import with_audit
from alluvia.operators.changes import current_for_batch
from alluvia.operators.rows import dedup_batch, required_keys, unseen
from alluvia.sinks.history import HistoryTable
from alluvia.sinks.tables import append_batch, has_batches, load_appended

BatchHandler = Callable[[DataFrame, int], None]


def _started(writer: DataStreamWriter, checkpoint: str, every: str | None, name: str | None) -> StreamingQuery:
    """``every=None`` works off what is there and ends; an interval keeps going."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return (writer.queryName(name) if name else writer).start()


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "30 seconds",
    partition_by: Sequence[str] = (),
    name: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Exactly-once append to a parquet directory."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _started(writer, checkpoint, every, name)


def console_stream(df: DataFrame, checkpoint: str, every: str | None = "15 seconds", name: str | None = None):
    """Print the rows of each micro-batch, for watching a stream."""
    writer = df.writeStream.format("console").outputMode("append").option("truncate", "false")
    return _started(writer, checkpoint, every, name)


def batch_stream(
    df: DataFrame, handler: BatchHandler, checkpoint: str, every: str | None = "60 seconds", name: str | None = None
) -> StreamingQuery:
    """Hand every micro-batch to ``handler(batch, batch_id)``; the handler must bear replays."""
    return _started(df.writeStream.outputMode("update").foreachBatch(handler), checkpoint, every, name)


def fan_out(*handlers: BatchHandler) -> BatchHandler:
    """Several sinks for one read of the source."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for handler in handlers:
                handler(kept, batch_id)
        finally:
            kept.unpersist()

    return handle


def stream_id(batch: DataFrame, fallback: str = "batch") -> str:
    """Id of the running streaming query. It belongs to the checkpoint: kept over restarts, new with a new one."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return found or fallback


def clock(batch: DataFrame, batch_id: int) -> datetime:
    """The default batch time: now, once per batch."""
    return datetime.now(timezone.utc)


def history_handler(table: HistoryTable, batch_time=clock) -> BatchHandler:
    """Apply micro-batches to a type-2 table. A replayed batch finds its versions there and opens none."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_time(batch, batch_id))

    return handle


def append_handler(
    path: str,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] = ("kafka_timestamp",),
    partition_by: Sequence[str] = ("year", "month", "day"),
    batch_time=clock,
    cross_batch: bool = False,
    required: Sequence[str] | None = None,
) -> BatchHandler:
    """Deduplicate each micro-batch on its keys and append it once.

    Rows lacking one of the ``required`` keys (default: all keys) are dropped; NULL in another key is a value.

    By default, keys repeat across batches, as rows of an append log do. ``cross_batch`` also drops keys
    that are already stored.
    """

    needed = list(keys if required is None else required)
    nullable = [k for k in keys if k not in needed]

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        selected = batch.select(*dict.fromkeys([*columns, *[c for c in order if c in batch.columns]]))
        rows = required_keys(selected, needed)
        kept = dedup_batch(rows, keys, order).select(*columns)

        def append(fresh: DataFrame) -> None:
            # The audit date is one value for the whole batch, so there is nothing to balance by it.
            append_batch(with_audit(fresh, batch_time(batch, batch_id)), path, batch_id, stream_id(batch), partition_by)

        if not (cross_batch and has_batches(spark, path)):
            append(kept)
            return
        kept.persist()  # used twice
        try:
            # Only the stored keys that occur in this batch take part in the anti join.
            stored = current_for_batch(load_appended(spark, path), kept, keys, True, nullable)
            append(unseen(kept, stored, keys, nullable))
        finally:
            kept.unpersist()

    return handle
