"""Message and CSV writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from alluvia.operators.reports import sorted_rows

FILE_MESSAGES = 100_000  # fixed value: a packed file is read by one task, so this bounds the least work of a task


def write_message_files(messages: DataFrame, path: str) -> str:
    """Messages as JSON lines, readable by ``stream_messages``; packed, as every line repeats the names of all fields."""
    writer = messages.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", str(FILE_MESSAGES))
    writer.json(path)
    return path


def publish_messages(messages: DataFrame, broker: Mapping[str, str], topic: str) -> None:
    """Messages to a topic; needs the Kafka connector on the class path."""
    messages.select("key", "value").write.format("kafka").options(**broker, topic=topic).save()


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> str:
    """CSV with header, globally sorted across its part files; embedded quotes are doubled."""
    kept = df.persist() if order else df  # a global sort reads its rows twice: first for the bounds of its ranges
    try:
        rows = sorted_rows(kept, order) if order else kept
        rows.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    finally:
        if order:
            kept.unpersist()
    return path
