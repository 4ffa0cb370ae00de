"""Plain parquet tables that are replaced, appended to or upserted without readers seeing half a write.

A replaced table is a set of ``v=<n>`` directories; the newest one Spark has committed is the table. A
writer fills a fresh directory and only then moves the catalog entry, so no directory is ever read and
overwritten by the same job, and a failed job leaves the previous version in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from alluvia.operators.changes import upsert_merge
from alluvia.operators.rows import latest_per_key
from alluvia.sinks.folders import committed, is_complete, numbered


COMMIT_MARKER = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def balanced(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Let AQE size the output: small partitions merge, a hot one is split over several tasks and files."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_new(df: DataFrame, location: str, partition_by: Sequence[str] = (), balance: bool = True) -> str:
    """Fill one directory; Spark marks it as complete when the job has committed."""
    writer = (balanced(df, partition_by) if balance else df).write.mode("overwrite").option(COMMIT_MARKER, "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(location)
    return location


def live_version(spark: SparkSession, path: str) -> str | None:
    """Directory of the newest committed version, or None when the table was never written."""
    versions = numbered(spark, path, "v")
    return versions[max(versions)] if versions else None


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace the whole table (and its schema) with a new version; returns the new directory."""
    taken = numbered(df.sparkSession, path, "v")
    return write_new(df, f"{path}/v={max(taken, default=0) + 1:010d}", partition_by)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> str:
    """Directory of the live version; an absent table, or one without any column, is created empty."""
    location = live_version(spark, path)
    if location is not None and _has_columns(spark, location):
        return location
    return overwrite_table(spark.createDataFrame([], schema), path, partition_by)


def _has_columns(spark: SparkSession, location: str) -> bool:
    try:
        return bool(spark.read.parquet(location).columns)
    except AnalysisException as problem:
        if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return False


def load_table(spark: SparkSession, path: str) -> DataFrame:
    location = live_version(spark, path)
    if location is None:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.parquet(location)


def upsert_table(
    df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> str:
    """Update matching rows, insert the others; create the table when it does not exist yet.

    Existence is tested, never guessed from an exception: an error keeps the stored table as it is. This
    form writes a whole new version, which suits tables that are small next to their changes;
    ``UpsertTable`` is for large ones. The target is streamed past the source keys: AQE broadcasts a small
    source, and then the target is not shuffled.
    """
    spark = df.sparkSession
    source = latest_per_key(df, keys, order)
    stored = live_version(spark, path)
    if stored is None:
        return overwrite_table(source, path, partition_by)
    return overwrite_table(upsert_merge(spark.read.parquet(stored), source, keys), path, partition_by)


def append_batch(
    df: DataFrame, path: str, batch_id: int, writer_id: str = "batch", partition_by: Sequence[str] = (), balance: bool = False
) -> bool:
    """Append one batch under its own ``writer_id=/batch_id=`` directory.

    A replayed batch finds its committed directory and writes nothing, so at-least-once delivery does
    not duplicate rows. ``writer_id`` separates streams whose batch numbers start anew. Returns False
    for a replay. ``balance`` deals the rows anew by partition value, which a batch with one value each (the
    date of the batch) does not need.
    """
    location = f"{path}/writer_id={writer_id}/batch_id={batch_id}"
    if is_complete(df.sparkSession, location):
        return False
    write_new(df, location, partition_by, balance)
    return True


def load_appended(spark: SparkSession, path: str, evolve: bool = False) -> DataFrame:
    """The rows of all committed batches; a batch that died while committing is out of sight until its retry."""
    reader = spark.read.option("basePath", path).option("mergeSchema", str(evolve).lower())
    places = committed(spark, f"{path}/writer_id=*/batch_id=*")
    if not places:
        raise FileNotFoundError(f"no committed batch under {path}")
    return reader.parquet(*places).drop("writer_id", "batch_id")


def has_batches(spark: SparkSession, path: str) -> bool:
    return bool(committed(spark, f"{path}/writer_id=*/batch_id=*"))
