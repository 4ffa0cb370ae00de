"""Compaction of a plain Parquet directory where it lies: small files are packed into larger ones, all others stay as they are.

    _compaction/rows/...    the packed files, in folders as below the table
    _compaction/replaced/   names of the files whose rows they hold, written before

Spark's readers pass over names that begin with an underscore. Once the packed files are committed the exchange is certain: they are moved
into the table, then the replaced files are deleted, again after a crash as often as it takes. A reader that lists the table in
between sees those rows twice; readers that must not are served by a registered location (``plans/maintenance``). Directories
that a file stream writes or reads keep a log of their files, so they are refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession

from alluvia.operators.layout import TARGET_BYTES, file_sizes, packing_session, small_files
from alluvia.sinks.folders import exists, is_complete, make, matching, move, remove
from alluvia.sinks.tables import write_new


def compact_incremental(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, partition_by: Sequence[str] = ()) -> int:
    """Pack the files below ``target_bytes``; returns how many were replaced. ``partition_by`` names the table's directory levels."""
    path = path.rstrip("/")
    if exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is written by a stream, which logs its files")
    settle(spark, path)
    work = f"{path}/_compaction"
    chosen = small_files(file_sizes(spark, path), target_bytes).select("path")
    write_new(chosen, f"{work}/replaced")
    names = [unquote(r.path) for r in spark.read.parquet(f"{work}/replaced").collect()]  # file names, as any scan of the table lists them
    if not names:
        remove(spark, work)
        return 0
    own = packing_session(spark, target_bytes)
    write_new(own.read.option("basePath", path).parquet(*names), f"{work}/rows", partition_by)
    settle(spark, path)
    return len(names)


def settle(spark: SparkSession, path: str) -> None:
    """Finish an exchange that had been committed when a job died; one that had not is dropped."""
    path = path.rstrip("/")
    work = f"{path}/_compaction"
    if is_complete(spark, f"{work}/rows"):
        depth = 0
        while found := matching(spark, f"{work}/rows" + "/*=*" * depth + "/*.parquet") or matching(spark, f"{work}/rows" + "/*=*" * (depth + 1)):
            for place in found:
                if place.endswith(".parquet"):
                    inner = place.split("/_compaction/rows/", 1)[1]
                    make(spark, f"{path}/{inner}".rsplit("/", 1)[0])
                    move(spark, place, f"{path}/{inner}")
            depth += not found[0].endswith(".parquet")
        for r in spark.read.parquet(f"{work}/replaced").toLocalIterator():
            remove(spark, unquote(r.path))
    remove(spark, work)
