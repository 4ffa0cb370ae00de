"""Static documents to CSV files, and CSV files to bronze dimension tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from alluvia.config import LakeConfig
from alluvia.functions.audit import with_audit
from alluvia.plans.tables import DIMENSIONS, Dimension
from alluvia.schemas import STATIC_DATA
from alluvia.sinks.catalog import ensure_database, record_count, register_table
from alluvia.sinks.messages import write_csv
from alluvia.sinks.tables import overwrite_table
from alluvia.sources.files import read_csv_strict, read_documents


def static_to_csv(spark: SparkSession, document: str, folder: str) -> dict[str, str]:
    """Write ``units.csv``, ``items.csv``, ``traits.csv`` and ``augments.csv`` from a static document."""
    parsed = read_documents(spark, document, STATIC_DATA)
    return {
        name: write_csv(dimension.extract(parsed), f"{folder}/{name}.csv", dimension.order)
        for name, dimension in DIMENSIONS.items()
    }


def stamped(rows: DataFrame, at: datetime | None) -> DataFrame:
    return with_audit(rows, at, column="ingestion_timestamp", partitions=False)


def load_dimension(
    spark: SparkSession, config: LakeConfig, dimension: Dimension, source: str, at: datetime | None = None
) -> dict[str, object]:
    """One CSV file to its registered bronze table."""
    paths = config.paths("bronze", dimension.table)
    ensure_database(spark, paths.database)
    place = overwrite_table(stamped(read_csv_strict(spark, source, dimension.schema), at), paths.data)
    register_table(spark, paths.name, place)
    return {"status": "SUCCESS", "count": record_count(spark.read.parquet(place)), "path": place, "catalog": paths.name}


def load_dimensions(
    spark: SparkSession, config: LakeConfig, folder: str, names: Iterable[str] = tuple(DIMENSIONS),
    at: datetime | None = None,
) -> dict[str, dict[str, object]]:
    """Load several dimensions; one that fails is reported and does not keep the others from loading."""
    outcome: dict[str, dict[str, object]] = {}
    for name in names:
        try:
            outcome[name] = load_dimension(spark, config, DIMENSIONS[name], f"{folder}/{name}.csv", at)
        except Exception as problem:  # reported per table, and in the exit code
            outcome[name] = {"status": "FAILED", "error": str(problem)}
    return outcome


def exit_code(outcome: dict[str, dict[str, object]]) -> int:
    return int(any(result["status"] != "SUCCESS" for result in outcome.values()))
