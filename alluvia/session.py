"""Session factory: SQL-level settings only, cluster sizing stays with spark-submit."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Shuffle width of a job kind and AQE's target partition size. ``initial`` is the width AQE
# starts from before it merges: wide for jobs over whole tables, narrower for bounded micro-batches.
PROFILES = {
    "bronze": {"shuffle": 50, "initial": 200, "advisory": "64MB", "min_partition": "32MB"},
    "silver": {"shuffle": 100, "initial": 1000, "advisory": "128MB", "min_partition": "64MB"},
    "gold": {"shuffle": 200, "initial": 4000, "advisory": "128MB", "min_partition": "64MB"},
    "batch": {"shuffle": 200, "initial": 4000, "advisory": "128MB", "min_partition": "64MB"},
}


def profile_settings(profile: str) -> dict[str, str]:
    """SQL settings of a job kind.

    Give a wider ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` through ``extra`` for very
    large shuffles. Join strategy is left to table sizes: no broadcast hint anywhere in the library, only
    the size-checked automatic threshold.
    """
    chosen = PROFILES[profile]
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(chosen["initial"]),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": chosen["min_partition"],
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": chosen["advisory"],
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "50MB",
        "spark.sql.shuffle.partitions": str(chosen["shuffle"]),
        "spark.sql.streaming.metricsEnabled": "true",
    }


def build_session(app: str, profile: str = "batch", extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(f"{app}-{profile}")
    for name, value in {**profile_settings(profile), **(extra or {})}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh directory for written intermediates: below ``spark.checkpoint.dir``, or the warehouse where that is unset.

    Both are places that all executors see; a machine's own temporary folder never is.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
