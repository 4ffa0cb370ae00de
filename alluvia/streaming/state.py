"""Deduplication over all batches of a stream, by state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dedup_within(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row of each key to arrive, however often the key comes again within ``delay`` of event time.

    The keys seen live in Spark's state store, so they outlast restarts from the checkpoint, and a key is forgotten once the watermark has
    passed its expiry: state is bounded by the keys of one delay, not by the stream. Rows older than the watermark are dropped. NULL
    is a key like any other. The number of shuffle partitions is part of the checkpoint; set it for the state's final size.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
