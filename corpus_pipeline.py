"""The corpus pipeline: documents become a training mix in five stages.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept: toxic documents go, documents that fail the quality
policy go, one document of each near-duplicate group stays (the one of the least id), documents that leak a benchmark item go, and
what is left is mixed to the sources' target weights. All stages but the last return the columns of documents as they came; the
last adds ``copy`` and ``time``, one row for each time that training meets a document, in training order.

Null texts are empty texts: not toxic by themselves, rejected by the quality rules. Rows with a null id are kept and dropped like
others. Rows that repeat an id and its text are one document for mixing. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alluvia.llm import decontamination, mixing, near_dedup, quality, toxicity
from alluvia.llm.store import stored
from alluvia.llm.words import free_name
from alluvia.llm.workers import reachable
from alluvia.queries.registry import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below their language's threshold."""
    model = toxicity.train(docs, table(reachable(spark), sf_dir, "labels"))
    made = free_name(docs, "_toxicity")
    scored = toxicity.score(docs, model, into=made)
    return scored.filter(F.col(f"{made}.score") < toxicity.threshold(model, F.col("lang"))).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy."""
    reachable(spark)
    made = free_name(docs, "_ledger")
    rows = quality.ledger(docs, into=made)
    return rows.filter(quality.passes(F.col(f"{made}.fail_bits"), quality.POLICY)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the least id, null ids last."""
    reachable(spark)
    labels = near_dedup.classes(docs)
    node, label, first = (free_name(docs, n) for n in ("_node", "_label", "_first"))
    ids = docs.select(F.col("doc_id").alias("id"), near_dedup.digest(F.col("text")).alias("node")).join(labels, "node", "left")
    chosen = ids.groupBy(F.coalesce("label", "node").alias("label")).agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("kept")).select("kept.id", "kept.node")
    rows = docs.withColumn(node, near_dedup.digest(F.col("text")))
    kept = rows.join(chosen, F.col(node).eqNullSafe(chosen["node"]) & rows["doc_id"].eqNullSafe(chosen["id"]), "left_semi")
    # Rows that repeat an id and its text: one stays.
    order = Window.partitionBy("doc_id", node).orderBy(F.xxhash64(*docs.columns))
    return kept.withColumn(first, F.row_number().over(order)).filter(F.col(first) == 1).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    found = decontamination.leaking_texts(docs, table(reachable(spark), sf_dir, "benchmark")).select("id", "version").distinct()
    found = stored(found, "pipeline-leaking")  # written, so that Spark knows its size: small, it is broadcast and the texts stay where they are
    return docs.join(found, docs["doc_id"].eqNullSafe(found["id"]) & (decontamination.version(docs["text"]) == found["version"]), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time that training meets a document, range-sorted by that time."""
    reachable(spark)
    key, copy, time, once = (free_name(docs, n) for n in ("_key", "copy", "time", "_once"))
    rows = docs.withColumn(key, F.struct(F.col("doc_id").alias("id"), decontamination.version(F.col("text")).alias("version")))
    # Rows that repeat an id and its text are one document, of their least source.
    sizes = rows.select(key, "source", mixing.word_count(F.col("text")).alias("size")).groupBy(key).agg(
        F.min("source").alias("source"), F.max("size").alias("size"), F.count("*").alias("n"))
    n = docs.count()
    sizes = stored(sizes, "pipeline-sizes", n)
    # Written by themselves: as few as they are, they are broadcast, and texts that stand alone stay where they are.
    repeated = stored(sizes.filter("n > 1").select(F.col(f"{key}.id").alias("id"), F.col(f"{key}.version").alias("version")), "pipeline-repeated", n)
    again = rows[key]["id"].eqNullSafe(repeated["id"]) & (rows[key]["version"] == repeated["version"])
    first = Window.partitionBy(key).orderBy(F.xxhash64(*(rows[c] for c in docs.columns)))  # which of them is met does not matter
    others = rows.join(repeated, again, "left_semi").withColumn(once, F.row_number().over(first)).filter(F.col(once) == 1).drop(once)
    rows = rows.join(repeated, again, "left_anti").unionByName(others)
    mixed = mixing.mix(sizes, key=key, size=F.col("size"), rows=n).filter("copies > 0").select(f"{key}.id", f"{key}.version", "times")
    met = rows.join(mixed, rows[key]["version"].eqNullSafe(mixed["version"]) & rows[key]["id"].eqNullSafe(mixed["id"]))
    copies = met.select(*(met[c] for c in docs.columns), F.posexplode("times").alias(copy, time))
    return copies.repartitionByRange(time, "doc_id", copy).sortWithinPartitions(time, "doc_id", copy)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: A trained network, sampling and graph components are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
