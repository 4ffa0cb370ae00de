"""Streaming readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.schemas import ENVELOPE
from alluvia.sinks.folders import make
from alluvia.sources.files import read_table


def topic_options(topic: str, broker: Mapping[str, str]) -> dict[str, str]:
    """Options of the Kafka reader. ``broker`` has the connector's own option names and has the last word, so security,
    offsets, consumer group and rate limits are whatever the user gives."""
    usual = {"subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false"}
    return usual | dict(broker)


def read_topic(spark: SparkSession, topic: str, broker: Mapping[str, str]) -> DataFrame:
    """One topic as a stream of (key, value, timestamp); needs the Kafka connector on the class path."""
    source = spark.readStream.format("kafka").options(**topic_options(topic, broker)).load()
    return source.select("key", "value", "timestamp")


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same envelope from a directory of JSON message files."""
    return _bounded(spark.readStream.schema(ENVELOPE), max_files, None).json(path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """A growing parquet directory as a stream, with a bound on each micro-batch.

    Only newly added files are read: files rewritten or removed upstream are ignored, so the stream
    tolerates upstream changes without extra switches. With a schema, the directory need not hold anything yet, and columns that a
    file lacks are NULL; without one, the schemas of all files there are merged.
    """
    if schema is None:
        schema = read_table(spark, path, evolve=True).schema
    else:
        make(spark, path)
    return _bounded(spark.readStream.schema(schema), max_files, max_bytes).parquet(path)


def _bounded(reader, max_files: int | None, max_bytes: int | None):
    if max_files is not None and max_bytes is not None:
        raise ValueError("bound a micro-batch by files or by bytes, not both")
    if max_files is not None:
        return reader.option("maxFilesPerTrigger", str(max_files))
    if max_bytes is not None:
        return reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader


def events_from_rate(ticks: DataFrame, amount: Column | None = None) -> DataFrame:
    """Demo events from the (timestamp, value) rows of a rate source, batch or stream."""
    value = F.col("value")
    kind = F.when(value % 3 == 0, "purchase").when(value % 3 == 1, "view").otherwise("click")
    return ticks.select(
        value.cast("long").alias("id"),
        F.concat(F.lit("User_"), value.cast("string")).alias("name"),
        kind.alias("event_type"),
        (F.floor(F.rand() * 1000) if amount is None else amount).cast("int").alias("amount"),
        F.col("timestamp").alias("ingest_ts"),
    )


def read_rate_batches(
    spark: SparkSession, rows_per_batch: int, start_ms: int = 0, advance_ms: int = 1000, partitions: int | None = None
) -> DataFrame:
    """Ticks that are the same in every run: micro-batch n has the next ``rows_per_batch`` values, all at ``start_ms + n * advance_ms``."""
    reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).option("startTimestamp", start_ms)
    reader = reader.option("advanceMillisPerBatch", advance_ms)
    return (reader.option("numPartitions", partitions) if partitions else reader).load()


def read_rate_events(spark: SparkSession, rows_per_second: int = 5) -> DataFrame:
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return events_from_rate(ticks)
