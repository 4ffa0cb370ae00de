"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

Every source has a base weight and a schedule: its share of the mix changes linearly over training. Three steps:

* Targets. All sizes together are shared out by base weight; a source gets at most ``repeats`` times its own size, and what is
  above that is shared out again among the others until no source is above.
* Offsets. The documents of a source stand in a hashed order, and a running sum of sizes gives each the range of words it covers.
  A target of ``q`` times the source's size is ``floor(q)`` whole passes and a last one that ends where the target is reached;
  the document across that point is in when most of it lies before, so a source misses its target by less than one document.
* Positions. The integral of a source's schedule, divided by its target, is its cumulative demand; inverting it at the offset of
  each copy gives the time in [0, 1) at which training meets the copy. ``in_training_order`` range-sorts the copies by that time: that is
  the mix, and the query's figures are counted in it.

Running sums never put a source into one task: documents are dealt by hash into ``slices`` per source, the slices are summed
first, and the running sum inside a slice starts from the sum of the slices before. A source's slices are as many as its
number of documents asks for, so a slice stays near ``per_slice`` documents at every size.

Null texts have size 0. Documents of size 0 take 0 words and have no copies. A null source is a source of its own, last in
order. Repeated rows are documents of their own (ties in the hashed order are broken by id and a row number within the slice).
An empty table gives an empty result; columns that are not asked for are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alluvia.llm.store import stored
from alluvia.queries.registry import table

#: Documents that one running-sum task of a source holds, about.
PER_SLICE = 50_000


@dataclass(frozen=True)
class Curriculum:
    """Base weights by rank of the source, and the schedule's slopes: share at time t is target * (1 + slope * (2 t - 1))."""

    weights: tuple[float, ...] = (1.0, 2.0, 3.0)
    slopes: tuple[float, ...] = (-0.6, 0.0, 0.6)
    repeats: float = 3.0


def word_count(text: Column) -> Column:
    """Words of a text: one more than its separator runs once the outer ones are gone."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", "")
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, "[\\x20\\x09-\\x0D]+"))).cast("long")


def by_rank(values: tuple[float, ...], rank: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (rank % len(values)).cast("int"))


def targets(sources: DataFrame, plan: Curriculum) -> DataFrame:
    """Rank, target and slope of each source, from one row per source with its size and its number of documents. Its running sums
    go over this table of sources alone.

    The source that hits its bound first is the one with the least size per weight. In that order the bounded sources are a
    prefix: source k is bounded when its share of what the prefix before it leaves, by the weights that are left, is above its
    bound. So the repeated re-sharing is one running sum over the table of sources.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", by_rank(plan.weights, F.col("rank")))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    bound = F.col("source_size") * F.lit(plan.repeats)
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum(bound).over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("bounded", F.col("rest") * F.col("weight") / F.col("weight_left") > bound)
    )
    # The first source below its bound opens the tail that shares what is left.
    first_free = F.min(F.when(~F.col("bounded"), F.struct(F.col("source_size") / F.col("weight"), "rank", "rest", "weight_left"))).over(everything)
    return ranked.withColumn("free", first_free).select(
        "source", "source_size", "n_docs", "rank",
        F.when(F.col("bounded"), bound).otherwise(F.col("free.rest") * F.col("weight") / F.col("free.weight_left")).alias("target"),
        by_rank(plan.slopes, F.col("rank")).alias("slope"),
    )


def moment(share: Column, slope: Column) -> Column:
    """The time at which a source has met ``share`` of its demand: the schedule's integral (1 - s) t + s t^2, inverted."""
    flat = F.abs(slope) < 1e-9
    root = F.sqrt(F.pow(1 - slope, F.lit(2.0)) + 4 * slope * share)
    return F.when(flat, share).otherwise(2 * share / ((1 - slope) + root))


def mix(docs: DataFrame, plan: Curriculum = Curriculum(), key: str = "doc_id", text: str = "text", source: str = "source",
        per_slice: int = PER_SLICE, size: Column | None = None, rows: int | None = None) -> DataFrame:
    """One row per document: its key, size, source_size, target, taken, copies, the times of its copies, and a number of its row.

    ``size`` is the number of words where it is known already; the texts are then not needed. ``rows`` is the number of rows, likewise.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    sized = stored(docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), (word_count(F.col(text)) if size is None else size).alias("size"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("order"),
        F.monotonically_increasing_id().alias("row")), "mix-sizes", rows)  # texts are read once
    fine = F.shiftright("order", 40)  # the first 20 of 60 bits
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    plan_rows = targets(stats, plan).withColumn("slices", F.least(F.lit(1 << 20), F.ceil(F.col("n_docs") / per_slice)).cast("long"))
    known = sized.join(plan_rows, sized["source"].eqNullSafe(plan_rows["source"])).drop(plan_rows["source"])
    sliced = known.withColumn("slice", F.floor(fine * F.col("slices") / F.lit(float(1 << 20))).cast("long"))
    per = sliced.groupBy("rank", "slice").agg(F.sum("size").alias("slice_size"))
    running = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("rank", "slice", F.coalesce(F.sum("slice_size").over(running), F.lit(0)).alias("slice_start"))
    inside = Window.partitionBy("rank", "slice").orderBy("order", "key", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sliced.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["rank", "slice"])
        .withColumn("offset", F.col("slice_start") + F.col("before"))
    )
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    last = F.col("target") - full * F.col("source_size")
    taken = placed.withColumn("copies", F.when(F.col("size") == 0, 0).otherwise(
        F.least(F.lit(plan.repeats).cast("long"),
                full + F.when(F.col("offset") + F.col("size") / 2 <= last, 1).otherwise(0))).cast("int"))
    times = F.when(F.col("copies") > 0, F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1),
        lambda p: moment(F.least(F.lit(1.0), (F.col("offset") + p * F.col("source_size")) / F.col("target")), F.col("slope")),
    )).otherwise(F.array().cast("array<double>"))
    return taken.select(F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                        "copies", times.alias("times"), "row")


def in_training_order(mixed: DataFrame, key: str = "doc_id", unmet: bool = False) -> DataFrame:
    """Rows of ``mix``, one for each copy, range-sorted by time, so that files hold the training order.

    ``unmet`` also keeps the documents that training does not meet, once each and before all others, without ``copy`` and ``time``.
    """
    made = F.posexplode_outer("times") if unmet else F.posexplode("times")
    copies = mixed.select(*[c for c in mixed.columns if c != "times"], made.alias("copy", "time"))
    order = ["time", key, "copy", "row"]
    return copies.repartitionByRange(*order).sortWithinPartitions(*order)


def curriculum(docs: DataFrame, plan: Curriculum = Curriculum(), key: str = "doc_id", text: str = "text",
               source: str = "source") -> DataFrame:
    """The mix itself: (key, copy, time) of every copy in training order."""
    return in_training_order(mix(docs, plan, key, text, source), key).select(key, "copy", "time")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = stored(in_training_order(mix(table(spark, sf_dir, "documents")).drop("taken", "copies"), unmet=True), "mix-order")
    met = order.groupBy("row", "doc_id", "size", "source_size", "target").agg(
        F.count("copy").cast("int").alias("copies"), F.round(F.min("time"), 6).alias("first_time"))
    return met.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "first_time")


OP6_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, (rank % 3 + 1)::DOUBLE AS weight, (rank % 3 - 1) * 0.6::DOUBLE AS slope FROM s),
r AS (SELECT *, sum(source_size) OVER ()::DOUBLE - coalesce(sum(source_size * 3.0::DOUBLE) OVER (
                ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
      FROM w),
b AS (SELECT *, rest * weight / weight_left > source_size * 3.0 AS bounded FROM r),
f AS (SELECT rest AS free_rest, weight_left AS free_weight FROM b WHERE NOT bounded ORDER BY source_size / weight, rank LIMIT 1),
t AS (SELECT source, source_size, slope,
             CASE WHEN bounded THEN source_size * 3.0::DOUBLE ELSE free_rest * weight / free_weight END AS target FROM b LEFT JOIN f ON true),
p AS (SELECT doc_id, size, source_size, target, slope, sum(size) OVER (
             PARTITION BY d.source ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS at_word,
             CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE least(3, passes + CASE WHEN at_word + size / 2 <= target - passes * source_size
             THEN 1 ELSE 0 END) END::INTEGER AS copies FROM p)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies,
       CASE WHEN copies > 0 THEN round(CASE WHEN abs(slope) < 1e-9 THEN least(1.0, at_word / target)
            ELSE 2 * least(1.0, at_word / target) / ((1 - slope) + sqrt(pow(1 - slope, 2) + 4 * slope * least(1.0, at_word / target)))
            END, 6) END AS first_time
FROM c
"""
