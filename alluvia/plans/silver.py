"""Bronze tables to silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from alluvia.config import LakeConfig, TablePaths
from alluvia.plans.tables import APPENDS, HISTORIES, MESSAGE_TABLES, AppendPlan, HistoryPlan, MessageTable
from alluvia.sinks.catalog import ensure_database, register_view
from alluvia.sinks.history import HistoryTable
from alluvia.sinks.tables import has_batches
from alluvia.sources.streams import stream_table
from alluvia.streaming.lifecycle import run_in_turn, run_together
from alluvia.streaming.sinks import append_handler, batch_stream, clock, history_handler

BATCH_BYTES = 50 * 1024 * 1024  # fixed value: bound on one micro-batch


def _bronze(spark: SparkSession, config: LakeConfig, kind: str, max_bytes: int | None, table: MessageTable | None = None):
    """The bronze table as a stream. Its schema is known, so silver may start before bronze has written anything."""
    table = table or MESSAGE_TABLES[kind]
    return stream_table(spark, config.paths("bronze", table.table).data, table.stored, max_bytes=max_bytes)


def history_table(spark: SparkSession, config: LakeConfig, kind: str, plan: HistoryPlan | None = None) -> HistoryTable:
    plan = plan or HISTORIES[kind]
    return HistoryTable(spark, config.paths("silver", plan.table).data, plan.spec, config.key_buckets)


def history_stream(
    spark: SparkSession, config: LakeConfig, kind: str, every: str | None = "60 seconds",
    max_bytes: int | None = BATCH_BYTES, batch_time=clock, plan: HistoryPlan | None = None, bronze: MessageTable | None = None,
) -> StreamingQuery:
    """``plan`` and ``bronze`` stand in for the known tables, as when both have come to hold more columns."""
    plan = plan or HISTORIES[kind]
    rows = plan.project(_bronze(spark, config, plan.source, max_bytes, bronze))
    handler = history_handler(history_table(spark, config, kind, plan), batch_time)
    checkpoint = config.paths("silver", plan.table).checkpoint
    return batch_stream(rows, handler, checkpoint, every, name=f"silver_{plan.table}")


def append_table_stream(
    spark: SparkSession, config: LakeConfig, kind: str, every: str | None = "60 seconds",
    max_bytes: int | None = BATCH_BYTES, batch_time=clock, cross_batch: bool = False, plan: AppendPlan | None = None,
    bronze: MessageTable | None = None,
) -> StreamingQuery:
    plan = plan or APPENDS[kind]
    paths = config.paths("silver", plan.table)
    rows = _bronze(spark, config, plan.source, max_bytes, bronze)
    handler = append_handler(
        paths.data, plan.keys, plan.columns, required=plan.required, batch_time=batch_time, cross_batch=cross_batch
    )
    return batch_stream(rows, handler, paths.checkpoint, every, name=f"silver_{plan.table}")


def register_silver(spark: SparkSession, config: LakeConfig) -> list[str]:
    """Make every silver table that holds data known to the catalog; returns their names."""
    known = []
    for kind, history in HISTORIES.items():
        table = history_table(spark, config, kind)
        if table.exists():
            known.append(_view(spark, config.paths("silver", history.table), table.view_sql()))
    for appended in APPENDS.values():
        paths = config.paths("silver", appended.table)
        if has_batches(spark, paths.data):
            columns = ", ".join([*appended.columns, "processed_ts", "year", "month", "day"])
            known.append(_view(spark, paths, f"SELECT {columns} FROM parquet.`{paths.data}`"))
    return known


def _view(spark: SparkSession, paths: TablePaths, select: str) -> str:
    ensure_database(spark, paths.database)
    register_view(spark, paths.name, select)
    return paths.name


def silver_stream(spark: SparkSession, config: LakeConfig, kind: str, every: str | None = "60 seconds") -> StreamingQuery:
    start = history_stream if kind in HISTORIES else append_table_stream
    return start(spark, config, kind, every)


def run_silver(
    spark: SparkSession, config: LakeConfig, kinds: Sequence[str] = ("match", "participant", "unit"),
    together: bool = True,
) -> None:
    """All silver streams side by side, or one after the other until each has caught up."""
    every = "60 seconds" if together else None
    starters = [lambda kind=kind: silver_stream(spark, config, kind, every) for kind in kinds]
    if together:
        run_together(spark, starters)
    else:
        run_in_turn(starters)
