"""Directories of tables, through Hadoop's file system API, so any URI scheme works.

A directory counts once the job that wrote it has committed, which Spark marks with ``_SUCCESS``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, fs = _path(spark, location)
    return fs.exists(path)


def is_complete(spark: SparkSession, location: str) -> bool:
    return exists(spark, f"{location}/_SUCCESS")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Files and directories that match a glob pattern."""
    path, fs = _path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(path) or []]


def make(spark: SparkSession, location: str) -> None:
    path, fs = _path(spark, location)
    fs.mkdirs(path)


def move(spark: SparkSession, location: str, to: str) -> None:
    path, fs = _path(spark, location)
    fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(to))


def remove(spark: SparkSession, location: str) -> None:
    path, fs = _path(spark, location)
    fs.delete(path, True)


def committed(spark: SparkSession, pattern: str) -> list[str]:
    """Committed directories that match a glob pattern."""
    path, fs = _path(spark, f"{pattern}/_SUCCESS")
    return [status.getPath().getParent().toString() for status in fs.globStatus(path) or []]


def numbered(spark: SparkSession, location: str, label: str) -> dict[int, str]:
    """Committed ``label=<number>`` children of a directory, by number."""
    places = committed(spark, f"{location}/{label}=*")
    return {int(place.rsplit("=", 1)[1]): place for place in places}
