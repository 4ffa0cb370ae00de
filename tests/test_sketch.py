"""The Bloom sketch: no false negative, few false positives, merging, and the same news as the exact join."""

import random

from pyspark.sql import functions as F

from alluvia.operators import sketch
from alluvia.operators.rows import unseen_ids


def test_sketch_knows_all_its_keys_and_few_others(spark):
    shape = sketch.Shape.for_keys(20_000)
    seen = spark.range(20_000).select(F.col("id").alias("k"))
    built = sketch.sketch(seen, ["k"], shape)
    assert sketch.maybe_in(seen, ["k"], built, shape).filter("NOT maybe").count() == 0
    others = spark.range(100_000, 120_000).select(F.col("id").alias("k"))
    assert sketch.maybe_in(others, ["k"], built, shape).filter("maybe").count() < 20_000 * 0.03


def test_merging_is_the_sketch_of_the_union(spark):
    shape = sketch.Shape(3)
    parts = [spark.range(n * 500, n * 500 + 700).select(F.col("id").cast("string").alias("k")) for n in range(3)]
    both = parts[0].union(parts[1]).union(parts[2])
    rows = [sorted((r.block, bytes(r.bits)) for r in s.collect()) for s in (
        sketch.merged(*(sketch.sketch(p, ["k"], shape) for p in parts)), sketch.sketch(both, ["k"], shape))]
    assert rows[0] == rows[1] and len(rows[0]) == 3


def test_size_is_bounded_and_news_are_exact(spark):
    assert sketch.Shape.for_keys(10**12).blocks * 4096 <= 32 << 20
    assert sketch.Shape.for_keys(0).blocks == 1
    rng = random.Random(1)
    ddl = "a int, b string"
    seen = spark.createDataFrame([(rng.randrange(400), rng.choice("xyz")) for _ in range(900)], ddl)
    incoming = spark.createDataFrame([(rng.randrange(800), rng.choice("xyz")) for _ in range(900)] + [(None, "x"), (1, None)], ddl)
    keys = ["a", "b"]
    for shape in (sketch.Shape.for_keys(900), sketch.Shape(1, 1)):  # one bit for each key: nearly all go through the exact join
        news = sketch.unseen_by_sketch(incoming, seen, keys, sketch.sketch(seen, keys, shape), shape)
        exact = unseen_ids(incoming, seen, keys)
        assert news.exceptAll(exact).count() == 0 and exact.exceptAll(news).count() == 0
    empty = seen.limit(0)
    assert sketch.unseen_by_sketch(incoming, empty, keys, sketch.sketch(empty, keys, shape), shape).count() == incoming.distinct().count()
