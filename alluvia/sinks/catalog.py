"""Databases and external tables over written directories."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.sinks.folders import matching
from alluvia.sinks.tables import live_version
from alluvia.sources.files import read_table

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the directory of NULL


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def quoted_column(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")


def register_table(spark: SparkSession, name: str, location: str, replace: bool = True) -> None:
    """Point ``database.table`` at a directory; its columns are those of all files there.

    An existing entry is moved where it is, so readers always find the table: columns that came are added, the location is set, and of
    a partitioned table one partition after the other follows. Columns that went stay and are NULL. Only when a column changed its type,
    or the partitioning changed, is the entry created anew.
    """
    rows = read_table(spark, location, evolve=True)
    if spark.catalog.tableExists(name):
        if not replace:
            return
        stored = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
        directories = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        fresh = [f for f in rows.schema.fields if f.name.lower() not in stored]
        same = all(stored.get(f.name.lower(), f.dataType) == f.dataType for f in rows.schema.fields)
        if same and _partition_columns(spark, location) == [d.lower() for d in directories]:
            if fresh:
                added = ", ".join(f"{quoted_column(f.name)} {f.dataType.simpleString()}" for f in fresh)
                spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({added})")
            _move(spark, name, location, directories)
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {quoted(name)}")
    kinds = ", ".join(f"{quoted_column(f.name)} {f.dataType.simpleString()}" for f in rows.schema.fields)
    directories = _partition_columns(spark, location)
    parted = f" PARTITIONED BY ({', '.join(map(quoted_column, directories))})" if directories else ""
    spark.sql(f"CREATE TABLE {quoted(name)} ({kinds}) USING parquet{parted} LOCATION {literal(location)}")
    if directories:
        spark.catalog.recoverPartitions(name)


def _partition_columns(spark: SparkSession, location: str) -> list[str]:
    """Names of the directory levels of a table, outermost first."""
    levels, here = [], location.rstrip("/")
    while found := [p for p in matching(spark, f"{here}/*=*") if not p.rsplit("/", 1)[1].startswith(("_", "."))]:
        here = found[0]
        levels.append(here.rsplit("/", 1)[1].split("=", 1)[0].lower())
    return levels


def _move(spark: SparkSession, name: str, location: str, directories: list[str]) -> None:
    """Set the location; partitions keep places of their own, so each is added, moved or dropped."""
    spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION {literal(location)}")
    if not directories:
        return
    home = location.rstrip("/")
    listed = [r[0] for r in spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()]  # the catalog's own list
    wanted = {place.split(f"{home.rsplit('/', 1)[1]}/", 1)[1]: place for place in matching(spark, home + "/*=*" * len(directories))}

    def spec(partition: str) -> str:
        values = (piece.split("=", 1) for piece in partition.split("/"))
        return ", ".join(
            f"{quoted_column(k)} = {'NULL' if v == DEFAULT_PARTITION else literal(unquote(v))}" for k, v in values)

    for partition, place in wanted.items():
        if partition in listed:
            spark.sql(f"ALTER TABLE {quoted(name)} PARTITION ({spec(partition)}) SET LOCATION {literal(place)}")
        else:
            spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS PARTITION ({spec(partition)}) LOCATION {literal(place)}")
    for partition in listed:
        if partition not in wanted:
            spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS PARTITION ({spec(partition)})")


def register_view(spark: SparkSession, name: str, select: str) -> None:
    """A stored view; it replaces a table or view of that name, never any data."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {quoted(name)}")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {select}")


def create_empty_table(spark: SparkSession, name: str, columns: str, location: str, properties: dict[str, str]) -> None:
    """Create or replace an external table with the given DDL columns; written data is left alone."""
    listed = ", ".join(f"{literal(key)} = {literal(value)}" for key, value in properties.items())
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    spark.sql(
        f"CREATE TABLE {quoted(name)} ({columns}) USING parquet LOCATION {literal(location)}"
        + (f" TBLPROPERTIES ({listed})" if listed else "")
    )


def insert_overwrite(df: DataFrame, name: str) -> None:
    df.write.insertInto(name, overwrite=True)
    df.sparkSession.catalog.refreshTable(name)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {quoted(database)}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {quoted(name)}")


def table_or_path(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The catalog table, or the newest written directory when the catalog does not know it.

    Only the catalog's own errors lead to the path; a broken table or a failing job still raises.
    """
    try:
        return spark.table(name)
    except AnalysisException as problem:
        if problem.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "_LEGACY_ERROR_TEMP_3065"):
            raise
    return spark.read.parquet(live_version(spark, path) or path)


def sample_rows(df: DataFrame, count: int = 5) -> DataFrame:
    """A few rows to look at."""
    return df.limit(count)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def record_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]
