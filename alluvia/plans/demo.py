"""The demo event stream: produce, enrich, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alluvia.config import LakeConfig
from alluvia.operators import reports
from alluvia.sources.streams import read_rate_events, stream_table
from alluvia.streaming.sinks import append_stream, console_stream

EVENTS, PROCESSED = "streaming_events", "streaming_events_processed"
MONITORED = ["id", "name", "event_type", "amount", "revenue_tier", "processing_delay_seconds"]


def produce_events(spark: SparkSession, config: LakeConfig, every: str = "10 seconds") -> StreamingQuery:
    paths = config.paths("bronze", EVENTS)
    return append_stream(read_rate_events(spark), paths.data, paths.checkpoint, every)


def process_events(
    spark: SparkSession, config: LakeConfig, every: str | None = "15 seconds", monitor: bool = True
) -> list[StreamingQuery]:
    """Enrich the event table into a second table, and show the rows on the console."""
    enriched = reports.enrich_events(stream_table(spark, config.paths("bronze", EVENTS).data))
    paths = config.paths("bronze", PROCESSED)
    running = [append_stream(enriched, paths.data, paths.checkpoint, every)]
    if monitor:
        running.append(console_stream(enriched.select(*MONITORED), f"{paths.checkpoint}_console", every))
    return running


def event_reports(events: DataFrame) -> dict[str, DataFrame]:
    """The reports on the event table."""
    return {
        "latest": reports.top_rows(events, ["id"]),
        "total": reports.total(events),
        "by_type": reports.count_by(events, ["event_type"], by_count=True),
    }


def processed_reports(processed: DataFrame) -> dict[str, DataFrame]:
    """The reports on the enriched event table."""
    delay = reports.value_range(processed, "processing_delay_seconds", "delay")
    return {
        "latest": reports.top_rows(processed, ["id"]),
        "total": reports.total(processed),
        "by_tier": reports.tier_stats(processed, "revenue_tier", "amount"),
        "by_type_and_tier": reports.count_by(processed, ["event_type", "revenue_tier"]),
        "delay": delay,
    }


def dimension_summary(units: DataFrame, traits: DataFrame, items: DataFrame, augments: DataFrame) -> dict[str, DataFrame]:
    """What the static dimensions hold."""
    chosen = F.col("set") == 14  # fixed value: the set shown as a sample
    return {
        "unit_sets": reports.distinct_sorted(units, "set"),
        "unit_costs": reports.value_counts(units, "cost", by_count=False),
        "unit_sample": reports.top_rows(
            units.filter(chosen).select("cost", "unit_name", "all_traits"), ["cost", "unit_name", "all_traits"], 10, False
        ),
        "trait_sets": reports.distinct_sorted(traits, "set"),
        "trait_sample": reports.top_rows(traits.filter(chosen).select("trait_name"), ["trait_name"], 15, False),
        "item_sets": reports.distinct_sorted(items, "set"),
        "item_kinds": reports.conditional_counts(
            items, {"components": F.col("num_components") == 0, "completed": F.col("num_components") == 2}
        ),
        "augment_sets": reports.distinct_sorted(augments, "set"),
        "augment_tiers": reports.value_counts(augments, "tier"),
    }
