"""Compaction and clustering of bronze tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.config import LakeConfig
from alluvia.operators.layout import TARGET_BYTES, clusterable, compact, compare_stats, files_for, table_stats, zorder
from alluvia.plans.tables import MESSAGE_TABLES
from alluvia.sinks.catalog import ensure_database, quoted, register_table, register_view
from alluvia.sinks.folders import exists, numbered
from alluvia.sinks.tables import write_new
from alluvia.sources.files import read_table


@dataclass
class Outcome:
    optimized: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    unchanged: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    reports: dict[str, dict[str, object]] = field(default_factory=dict)


def optimize_table(
    spark: SparkSession, source: str, target: str, cluster_by: Sequence[str] = (), target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """Rewrite ``source`` as ``target``, clustered when columns are given; returns the before/after report.

    The rows stay the same and the source is left as it is, so streams that read it go on undisturbed.
    """
    rows = spark.read.parquet(source)
    columns = clusterable(rows, cluster_by)
    if columns:
        write_new(zorder(rows, columns, files_for(spark, source, target_bytes, rows)), target)
    else:
        compact(spark, source, target, target_bytes)
    return compare_stats(table_stats(spark, source), table_stats(spark, target))


def _after(rows: DataFrame, upto: int | None) -> DataFrame:
    return rows if upto is None else rows.filter(F.col("processed_ts") > F.timestamp_micros(F.lit(upto)))


def optimized_upto(spark: SparkSession, home: str) -> int | None:
    """The processing time (microseconds) up to which a table has been optimized, from the names of the committed runs."""
    return max(numbered(spark, home, "upto"), default=None)


def optimize_bronze(
    spark: SparkSession, config: LakeConfig, kinds: Sequence[str] = ("match", "participant", "unit"),
    target_bytes: int = TARGET_BYTES,
) -> Outcome:
    """Optimized copies of what came to the bronze message tables since the last run, and their publication.

    A run writes ``<table>_optimized/upto=<time>``: the rows with a processing time after the last run's and up to its own, so no row is
    rewritten twice and streams that read the bronze table go on undisturbed. The catalog's entry of the table then reads the runs, and
    the bronze files for what is younger; the bound on the time prunes the older ones by their statistics. It changes in one step.
    """
    outcome = Outcome()
    for kind in kinds:
        plan = MESSAGE_TABLES[kind]
        paths = config.paths("bronze", plan.table)
        if not exists(spark, paths.data):
            outcome.skipped.append(plan.table)
            continue
        home = config.paths("bronze", f"{plan.table}_optimized").data
        try:
            rows = _after(read_table(spark, paths.data, evolve=True), optimized_upto(spark, home))
            upto = rows.agg(F.max(F.unix_micros("processed_ts"))).first()[0]
            if upto is None:
                outcome.unchanged.append(plan.table)
            else:
                target = f"{home}/upto={upto:020d}"
                settled = rows.filter(F.col("processed_ts") <= F.timestamp_micros(F.lit(upto)))
                columns = clusterable(settled, plan.cluster_by)
                write_new(zorder(settled, columns, files_for(spark, paths.data, target_bytes, settled)) if columns else settled, target)
                report = compare_stats(table_stats(spark, paths.data), table_stats(spark, home))
                outcome.reports[plan.table] = report.first().asDict()  # a single row
                outcome.optimized.append(plan.table)
            publish(spark, config, kind)
        except Exception as problem:  # reported per table, the others still run
            outcome.failed[plan.table] = str(problem)
    return outcome


def published_sql(spark: SparkSession, config: LakeConfig, kind: str) -> str:
    """A bronze table as a SELECT over its optimized runs and the files that came after the last of them.

    The bronze files are read through a catalog entry of their own, which has the columns of all of them; a path in SQL has those of one.
    """
    plan = MESSAGE_TABLES[kind]
    source, home = (config.paths("bronze", name).data for name in (plan.table, f"{plan.table}_optimized"))
    columns = read_table(spark, source, evolve=True).schema
    runs = numbered(spark, home, "upto")
    alike: dict[tuple[str, ...], list[str]] = {}
    for run, place in sorted(runs.items()):
        alike.setdefault(tuple(spark.read.parquet(place).columns), []).append(place.rsplit("/", 1)[1])

    def shown(present: Sequence[str]) -> str:
        return ", ".join(f"`{f.name}`" if f.name in present else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                         for f in columns.fields)

    parts = [f"SELECT {shown(present)} FROM parquet.`{home}/{{{','.join(places)}}}`" for present, places in alike.items()]
    tail = f"SELECT {shown(columns.names)} FROM {quoted(files_name(config, kind))}"
    parts.append(f"{tail} WHERE processed_ts > timestamp_micros({max(runs)})" if runs else tail)
    return " UNION ALL ".join(parts)


def files_name(config: LakeConfig, kind: str) -> str:
    return f"{config.paths('bronze', MESSAGE_TABLES[kind].table).name}_files"


def publish(spark: SparkSession, config: LakeConfig, kind: str) -> str:
    """Let the catalog's entry of a bronze table read the optimized rows."""
    paths = config.paths("bronze", MESSAGE_TABLES[kind].table)
    ensure_database(spark, paths.database)
    register_table(spark, files_name(config, kind), paths.data)
    register_view(spark, paths.name, published_sql(spark, config, kind))
    return paths.name
