"""Reporting queries over finished tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.functions.audit import moment
from alluvia.functions.labels import threshold_label

# Upper bounds of the revenue tiers.
REVENUE_BOUNDS = [(200, "low"), (600, "medium"), (900, "high")]
REVENUE_ABOVE = "premium"


def revenue_tier(amount: Column, bounds: Sequence[tuple[float, str]] = REVENUE_BOUNDS) -> Column:
    return threshold_label(amount, bounds, REVENUE_ABOVE)


def delay_seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds between two times, both cut to the second first."""
    return F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))


def enrich_events(
    events: DataFrame, at=None, amount: str = "amount", time: str = "ingest_ts",
    bounds: Sequence[tuple[float, str]] = REVENUE_BOUNDS,
) -> DataFrame:
    """Processing time, revenue tier, weekday (1 = Sunday), hour and processing delay of demo events."""
    processed = moment(at)
    return events.withColumns({
        "processing_ts": processed,
        "revenue_tier": revenue_tier(F.col(amount), bounds),
        "day_of_week": F.dayofweek(time),
        "hour_of_day": F.hour(time),
        "processing_delay_seconds": delay_seconds(processed, F.col(time)),
    })


def total(df: DataFrame, name: str = "total_records") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count", by_count: bool = False) -> DataFrame:
    """Rows per key group, ordered by the keys or by falling count."""
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return grouped.orderBy(*([F.desc(name)] if by_count else []), *keys)


def tier_stats(df: DataFrame, tier: str, value: str) -> DataFrame:
    """Count and average per tier, the highest average first."""
    stats = df.groupBy(tier).agg(F.count(F.lit(1)).alias("count"), F.avg(value).alias("avg_amount"))
    return stats.orderBy(F.desc("avg_amount"), tier)


def value_range(df: DataFrame, value: str, label: str) -> DataFrame:
    return df.agg(
        F.avg(value).alias(f"avg_{label}"),
        F.min(value).alias(f"min_{label}"),
        F.max(value).alias(f"max_{label}"),
    )


def value_counts(df: DataFrame, column: str, by_count: bool = True) -> DataFrame:
    """Frequency of every non-NULL value."""
    return count_by(df.filter(F.col(column).isNotNull()), [column], by_count=by_count)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])


def top_rows(df: DataFrame, order: Sequence[str], count: int = 10, descending: bool = True) -> DataFrame:
    """The first ``count`` rows of a total order: each task keeps only that many."""
    ranks = [F.desc(c) if descending else F.asc(c) for c in order]
    return df.orderBy(*ranks).limit(count)


def sorted_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Globally sorted. All other columns and then the input partition break ties, so that equal sort keys,
    and even exact copies of a row, can spread over several sorting tasks."""
    rest = [c for c in df.columns if c not in order]
    return df.withColumn("_from", F.spark_partition_id()).orderBy(*order, *rest, "_from").drop("_from")
