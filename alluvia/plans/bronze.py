"""Message topics to bronze tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from alluvia.config import LakeConfig
from alluvia.functions.audit import with_audit
from alluvia.operators.envelope import decode_messages
from alluvia.plans.maintenance import optimized_upto, publish
from alluvia.plans.tables import MESSAGE_TABLES, MessageTable
from alluvia.sinks.catalog import ensure_database, register_table
from alluvia.sinks.folders import exists
from alluvia.streaming.lifecycle import run_together
from alluvia.streaming.sinks import append_stream

# Opens the message stream of a topic: the Kafka reader, or a directory of message files.
Source = Callable[[str], DataFrame]


def bronze_stream(
    config: LakeConfig, source: Source, kind: str, every: str | None = "30 seconds", plan: MessageTable | None = None
) -> StreamingQuery:
    """``plan`` stands in for the known table, as when its messages have come to hold more fields: a stream that is started again with
    it goes on from its checkpoint, and earlier files have NULL there."""
    plan = plan or MESSAGE_TABLES[kind]
    paths = config.paths("bronze", plan.table)
    rows = with_audit(decode_messages(source(plan.topic), plan.schema))
    return append_stream(rows, paths.data, paths.checkpoint, every, name=f"bronze_{plan.table}")


def register_bronze(spark: SparkSession, config: LakeConfig) -> list[str]:
    """Make every bronze message table that holds data known to the catalog, with the columns of all its files; returns their names."""
    known = []
    for kind, plan in MESSAGE_TABLES.items():
        paths = config.paths("bronze", plan.table)
        if exists(spark, paths.data):
            ensure_database(spark, paths.database)
            if optimized_upto(spark, config.paths("bronze", f"{plan.table}_optimized").data) is None:
                register_table(spark, paths.name, paths.data)
            else:
                publish(spark, config, kind)
            known.append(paths.name)
    return known


def run_bronze(
    spark: SparkSession, config: LakeConfig, source: Source, kinds: Sequence[str] = ("match", "participant", "unit"),
    every: str | None = "30 seconds",
) -> None:
    """All message streams in one session; the first that fails stops the others."""
    run_together(spark, [lambda kind=kind: bronze_stream(config, source, kind, every) for kind in kinds])
