from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from alluvia.operators.layout import listing

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Parquet bytes of a task whose rows become whole documents.
SPREAD_BYTES = 128 * 1024


def spread(spark: SparkSession, folder: str, name: str, key: str, task_bytes: int = SPREAD_BYTES) -> DataFrame:
    """A table whose narrow rows each become a whole document: dealt by its key, as a scan's few splits would leave all of that work to
    few tasks. The number of tasks follows the table's size."""
    tasks = -(-listing(spark, f"{folder}/{name}.parquet").bytes // task_bytes)
    return table(spark, folder, name).repartition(max(spark.sparkContext.defaultParallelism, tasks), key)
