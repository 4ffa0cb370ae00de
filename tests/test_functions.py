import re
from datetime import datetime

from pyspark.sql import functions as F

from alluvia import functions as fn
from alluvia.operators.reports import REVENUE_ABOVE, REVENUE_BOUNDS, delay_seconds, revenue_tier


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_strip_markup_agrees_with_python(spark):
    texts = ["<b>x</b>", None, "", "  a\u00a0\u2003b\x0b\x1c c\x85 ", "no tags", "<p\nclass='x'>  y<br/>z", "a < b > c", "<>"]

    def expected(text):
        return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", text)).strip() if text else ""

    got = values(spark, [(t,) for t in texts], "t string", fn.strip_markup(F.col("t")))
    assert [g[0] for g in got] == [expected(t) for t in texts]


def test_leading_number(spark):
    texts = ["TFT14_Item", "xTFT14_", "TFT_", "TFT0_a", "TFT99999999999_", None, "TFT7x_"]
    got = values(spark, [(t,) for t in texts], "t string", fn.leading_number(F.col("t"), "TFT", "_"))
    assert [g[0] for g in got] == [14, None, None, None, None, None, None]


def test_labels(spark):
    rules = [("first", ["_i."]), ("second", ["gold", "_ii."])]
    texts = ["a_I.png", "a_ii.png", "GOLD_i.x", "Gold", "none", None]
    got = values(spark, [(t,) for t in texts], "t string", fn.first_label(F.col("t"), rules, "Unknown"))
    assert [g[0] for g in got] == ["first", "second", "first", "second", "Unknown", "Unknown"]


def test_revenue_tier_bounds(spark):
    assert (REVENUE_BOUNDS[-1], REVENUE_ABOVE) == ((900, "high"), "premium")
    got = values(spark, [(v,) for v in (199, 200, 599, 600, 899, 900, None)], "v int", revenue_tier(F.col("v")))
    assert [g[0] for g in got] == ["low", "medium", "medium", "high", "high", "premium", "premium"]


def test_arrays(spark):
    rows = [(None,), ([],), (["a"],), (["a", None, "c", "d", "e"],)]
    items = F.col("a")
    got = values(
        spark, rows, "a array<string>",
        *fn.element_columns(items, "x", 3), *fn.element_columns(items, "y", 2, fill=""), fn.safe_size(items),
        fn.array_text(items),
    )
    assert got == [
        (None, None, None, "", "", 0, ""),
        (None, None, None, "", "", 0, ""),
        ("a", None, None, "a", "", 1, "a"),
        ("a", None, "c", "a", "", 5, "a, c, d, e"),
    ]


def test_struct_columns_keep_width(spark):
    effects = [{"lo": i, "hi": i + 1} for i in range(6)]
    rows = [(effects,), ([],), (None,)]
    made = fn.struct_columns(F.col("e"), "t{n}_{part}", 5, {"min": "lo", "max": "hi"})
    df = spark.createDataFrame(rows, "e array<struct<lo int, hi int>>").select(*made)
    assert df.columns == [f"t{n}_{p}" for n in range(1, 6) for p in ("min", "max")]
    assert [tuple(r) for r in df.collect()] == [(0, 1, 1, 2, 2, 3, 3, 4, 4, 5), (None,) * 10, (None,) * 10]


def test_row_hash(spark):
    rows = [("a||", "b"), ("a", "||b"), (None, "b"), ("", "b")]
    loose = values(spark, rows, "x string, y string", fn.row_hash(["x", "y"]))
    strict = values(spark, rows, "x string, y string", fn.row_hash(["x", "y"], strict=True))
    assert loose[0] == loose[1] and loose[2] == loose[3]
    assert len(set(strict)) == 4


def test_surrogate_key_repeats_and_separates(spark):
    at = datetime(2024, 5, 6, 7, 8, 9, 123000)
    df = spark.createDataFrame([("m", 1), ("m", 2)], "a string, b long")
    one = [r[0] for r in df.select(fn.surrogate_key(["a", "b"], F.lit(at))).collect()]
    two = [r[0] for r in df.repartition(4).select(fn.surrogate_key(["a", "b"], F.lit(at))).collect()]
    assert set(one) == set(two) and len(set(one)) == 2
    assert any(k.startswith("m_1_20240506070809123_") for k in one)


def test_audit_and_delay(spark):
    at = datetime(2024, 2, 29, 23, 59, 59)
    row = fn.with_audit(spark.range(1), at).first()
    assert (row.processed_ts, row.year, row.month, row.day) == (at, 2024, 2, 29)
    assert fn.with_audit(spark.range(1), None, "seen", partitions=False).columns == ["id", "seen"]
    got = values(
        spark, [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 1, 0, 100000))],
        "a timestamp, b timestamp", delay_seconds(F.col("b"), F.col("a")),
    )
    assert got == [(60,)]


def test_unnest_equals_explode(spark):
    rows = [(1, [1, 2]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "k int, a array<int>")
    assert sorted(map(tuple, fn.unnest(df, "a", "v", "k").collect())) == [(1, 1), (1, 2)]
