import pytest
from pyspark.sql import functions as F

from alluvia.operators import layout
from alluvia.queries import maintenance as maintenance_queries
from alluvia.schemas import INT, STRING, record
from alluvia.sinks import catalog, compaction, tables
from alluvia.sinks.upserts import UpsertTable
from tests.conf import settings


def rows(spark, count, value="a"):
    return spark.range(count).select(F.col("id"), F.lit(value).alias("v"), (F.col("id") % 2).alias("part"))


def test_versions(spark, here):
    with pytest.raises(FileNotFoundError):
        tables.load_table(spark, f"{here}/t")
    tables.overwrite_table(rows(spark, 5), f"{here}/t")
    first = tables.live_version(spark, f"{here}/t")
    # A version is built from the table itself: nothing is read and overwritten at once.
    tables.overwrite_table(tables.load_table(spark, f"{here}/t").filter("id > 2"), f"{here}/t", ["part"])
    assert tables.live_version(spark, f"{here}/t") != first
    assert sorted(r.id for r in tables.load_table(spark, f"{here}/t").collect()) == [3, 4]
    assert spark.read.parquet(first).count() == 5


def test_failed_overwrite_keeps_the_live_version(spark, here):
    tables.overwrite_table(rows(spark, 5), f"{here}/t")
    with pytest.raises(Exception, match="broken"):
        tables.overwrite_table(rows(spark, 5).withColumn("v", F.raise_error(F.lit("broken"))), f"{here}/t")
    assert tables.load_table(spark, f"{here}/t").count() == 5
    tables.overwrite_table(rows(spark, 6), f"{here}/t")
    assert tables.load_table(spark, f"{here}/t").count() == 6


def test_upsert_table(spark, here):
    people = spark.createDataFrame([(1, "Ann"), (2, "Ben")], "id int, name string")
    tables.upsert_table(people, f"{here}/p", ["id"])
    tables.upsert_table(spark.createDataFrame([(2, "Bea"), (3, "Cy"), (3, "Cy")], people.schema), f"{here}/p", ["id"])
    got = sorted(map(tuple, tables.load_table(spark, f"{here}/p").collect()))
    assert got == [(1, "Ann"), (2, "Bea"), (3, "Cy")]
    with pytest.raises(Exception, match="broken"):
        tables.upsert_table(people.withColumn("name", F.raise_error(F.lit("broken"))), f"{here}/p", ["id"])
    assert tables.load_table(spark, f"{here}/p").count() == 3


def test_upsert_batches(spark, here):
    table = UpsertTable(spark, f"{here}/u", ["id"])
    with pytest.raises(FileNotFoundError):
        table.read()
    ddl = "id int, name string"

    def put(rows, kind=ddl):
        return table.upsert(spark.createDataFrame(rows, kind))

    def seen():
        return sorted(map(tuple, table.read().collect()), key=str)

    assert put([(1, "a"), (2, "b")]) and put([(2, "c"), (3, "d"), (3, "d")])
    assert seen() == [(1, "a"), (2, "c"), (3, "d")]
    assert put([(2, "c")]) and seen() == [(1, "a"), (2, "c"), (3, "d")]
    assert not put([])
    assert put([(None, "x"), (4, "e")]) and put([(None, "y")])
    assert seen() == [(1, "a"), (2, "c"), (3, "d"), (4, "e"), (None, "y")]
    # A batch may have one more column.
    assert put([(1, "z", True)], "id int, name string, more boolean")
    assert ("1", "z", "True") in [tuple(map(str, r)) for r in table.read().select("id", "name", "more").collect()]
    assert table.read().filter("more IS NULL").count() == 4


def test_an_upsert_rewrites_its_own_buckets(spark, here):
    table = UpsertTable(spark, f"{here}/u", ["id"], 8)
    table.upsert(spark.range(100).withColumn("v", F.lit(0)))

    def files():
        rows = spark.read.parquet(f"{here}/u/rows").select("bucket", F.input_file_name().alias("file")).distinct().collect()
        return {r.bucket: r.file for r in rows}

    before = files()
    table.upsert(spark.range(5, 6).withColumn("v", F.lit(1)))
    after = files()
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert table.read().filter("v = 1").count() == 1 and table.read().count() == 100


def test_uncommitted_batches_are_not_read(spark, here):
    tables.append_batch(spark.range(10), f"{here}/log", 0)
    spark.range(10).write.option(tables.COMMIT_MARKER, "false").parquet(f"{here}/log/writer_id=batch/batch_id=1")
    assert tables.load_appended(spark, f"{here}/log").count() == 10
    assert not tables.has_batches(spark, f"{here}/nothing")


def test_append_replay(spark, here):
    assert tables.append_batch(rows(spark, 4), f"{here}/a", 0, "w", ["part"])
    assert not tables.append_batch(rows(spark, 4), f"{here}/a", 0, "w", ["part"])
    assert tables.append_batch(rows(spark, 4), f"{here}/a", 0, "other", ["part"])
    assert tables.load_appended(spark, f"{here}/a").count() == 8
    wider = rows(spark, 1).withColumn("extra", F.lit(1))
    tables.append_batch(wider, f"{here}/a", 1, "w", ["part"])
    assert tables.load_appended(spark, f"{here}/a", evolve=True).filter("extra = 1").count() == 1


def test_ensure_table(spark, here):
    schema = record((INT, "a"), (STRING, "b"))
    place = tables.ensure_table(spark, f"{here}/e", schema)
    assert spark.read.parquet(place).columns == ["a", "b"]
    assert tables.ensure_table(spark, f"{here}/e", schema).endswith(place)
    rows(spark, 0).write.partitionBy("part").parquet(f"{here}/f/v=0000000001")  # committed, but without any file
    assert spark.read.parquet(tables.ensure_table(spark, f"{here}/f", schema)).columns == ["a", "b"]


def test_hot_partition_is_split_and_small_ones_merge(spark, here):
    with settings(spark, {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }):
        hot = spark.range(0, 200_000, 1, 16).select(
            F.xxhash64("id").alias("v"), F.when(F.col("id") < 10, 1).otherwise(0).alias("part")
        )
        tables.write_new(hot, f"{here}/h", ["part"])
    files = [f for f in spark.read.parquet(f"{here}/h").inputFiles()]
    assert sum("part=0" in f for f in files) > 3
    assert sum("part=1" in f for f in files) == 1
    assert spark.read.parquet(f"{here}/h").count() == 200_000


def test_catalog(spark, here):
    catalog.ensure_database(spark, "t_db")
    first = tables.overwrite_table(rows(spark, 3), f"{here}/c")
    catalog.register_table(spark, "t_db.c", first)
    assert spark.table("t_db.c").count() == 3
    catalog.register_table(spark, "t_db.c", tables.overwrite_table(rows(spark, 4), f"{here}/c"))
    assert spark.table("t_db.c").count() == 4
    catalog.register_table(spark, "t_db.c", first, replace=False)
    assert spark.table("t_db.c").count() == 4
    wider = tables.overwrite_table(rows(spark, 5).withColumn("w", F.lit(1)), f"{here}/c")
    catalog.register_table(spark, "t_db.c", wider)
    assert "w" in spark.table("t_db.c").columns
    split = tables.overwrite_table(rows(spark, 6), f"{here}/c", ["part"])
    catalog.register_table(spark, "t_db.c", split)
    assert spark.table("t_db.c").count() == 6
    assert [r.tableName for r in catalog.list_tables(spark, "t_db").filter("NOT isTemporary").collect()] == ["c"]
    described = {r.col_name: r.data_type for r in catalog.describe_table(spark, "t_db.c").collect()}
    assert "c" in described.values() or described["Table"] == "c"
    assert catalog.table_or_path(spark, "t_db.c", "nowhere").count() == 6
    assert catalog.table_or_path(spark, "t_db.gone", f"{here}/c").count() == 6
    assert catalog.table_or_path(spark, "no_db.gone", f"{here}/c").count() == 6
    assert catalog.has_rows(spark.table("t_db.c")) and not catalog.has_rows(spark.range(0))
    assert catalog.sample_rows(spark.table("t_db.c"), 5).count() == 5


def test_create_and_insert_overwrite(spark, here):
    catalog.ensure_database(spark, "t_db")
    catalog.create_empty_table(spark, "t_db.people", "id INT, name STRING", f"{here}/people", {"owner_team": "x"})
    people = spark.createDataFrame([(1, "Ann"), (2, "Ben")], "id int, name string")
    people.createOrReplaceTempView("fresh_people")
    catalog.insert_overwrite(spark.table("fresh_people"), "t_db.people")
    catalog.insert_overwrite(people.filter("id = 2"), "t_db.people")
    assert [tuple(r) for r in spark.table("t_db.people").collect()] == [(2, "Ben")]
    assert "owner_team" in str(spark.sql("SHOW TBLPROPERTIES t_db.people").collect())


def lineitem(spark):
    return spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")


def test_stats_and_compaction(spark, here):
    lineitem(spark).repartition(40).write.parquet(f"{here}/small")
    before = layout.table_stats(spark, f"{here}/small")
    assert before.first().num_files == 40
    layout.compact(spark, f"{here}/small", f"{here}/large")
    after = layout.table_stats(spark, f"{here}/large")
    assert after.first().num_files == 1
    report = layout.compare_stats(before, after).first()
    assert (report.files_saved, report.files_saved_pct) == (39, 97.5)
    assert spark.read.parquet(f"{here}/large").exceptAll(lineitem(spark)).count() == 0
    layout.compact(spark, f"{here}/small", f"{here}/several", target_bytes=400_000)
    assert 2 <= layout.table_stats(spark, f"{here}/several").first().num_files <= 12
    assert spark.read.parquet(f"{here}/several").count() == lineitem(spark).count()


def test_partitioned_compaction(spark, here):
    for _ in range(3):
        rows(spark, 100).write.mode("append").partitionBy("part").parquet(f"{here}/p")
    layout.compact(spark, f"{here}/p", f"{here}/q", partition_by=["part"])
    assert layout.table_stats(spark, f"{here}/q").first().num_files == 2
    assert spark.read.parquet(f"{here}/q").count() == 300


def test_empty_stats(spark, here):
    spark.range(0).write.parquet(f"{here}/e")
    stats = layout.table_stats(spark, f"{here}/e")
    assert stats.first().num_files == 1
    import os

    os.makedirs(f"{here}/nothing")
    nothing = layout.table_stats(spark, f"{here}/nothing")
    assert tuple(nothing.first()) == (0, 0, 0.0, 0.0)
    assert layout.compare_stats(nothing, nothing).first().files_saved_pct is None


def test_zorder_narrows_every_file(spark, here):
    source = lineitem(spark).withColumn("name", F.concat(F.lit("k"), F.col("l_suppkey").cast("string")))
    columns = ["l_orderkey", "l_partkey"]
    layout.zorder(source, columns, files=8).write.parquet(f"{here}/z")
    made = spark.read.parquet(f"{here}/z")
    assert made.count() == source.count() and made.exceptAll(source).count() == 0
    whole = source.agg(*[(F.max(c) - F.min(c)).alias(c) for c in columns]).first()
    spans = made.groupBy(F.input_file_name()).agg(*[(F.max(c) - F.min(c)).alias(c) for c in columns]).collect()
    assert len(spans) == 8
    # Eight boxes over two columns: a grid of two by four has a mean span of 3/8.
    assert sum(s[c] / whole[c] for s in spans for c in columns) / (8 * 2) < 1.3 * 3 / 8
    text = layout.zorder(source, ["name", "l_shipdate"], files=4)
    assert text.exceptAll(source).count() == 0


def test_cuts_of_whole_columns(spark):
    rows = spark.range(0, 10_000, 1, 7).select("id", F.lpad(F.col("id").cast("string"), 5, "0").alias("name"))
    for cuts in layout.find_cuts(rows, ["id", "name"], 3):
        places = [int(p) for p in cuts.points]
        assert len(places) == 7 and all(abs(p - 1250 * (i + 1)) < 400 for i, p in enumerate(places))
    assert [layout.bits_for(n, 2) for n in (1, 8, 64, 1024, 10**6)] == [3, 4, 5, 7, 8]


def test_zorder_spreads_a_hot_key(spark):
    hot = spark.range(0, 40_000, 1, 8).select(F.lit(7).alias("a"), F.lit("x").alias("b"))
    sizes = layout.zorder(hot, ["a", "b"], files=4).groupBy(F.spark_partition_id()).count().collect()
    assert sum(s["count"] for s in sizes) == 40_000 and max(s["count"] for s in sizes) < 25_000


def test_z_value_interleaves(spark):
    cuts = [layout.Cuts("a", (1, 2, 3)), layout.Cuts("b", (1, 2, 3))]
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    for r in df.select("a", "b", layout.z_value(cuts, 2).alias("z")).collect():
        wanted = (r.a >> 1) << 3 | (r.b >> 1) << 2 | (r.a & 1) << 1 | (r.b & 1)
        assert r.z == wanted
    with pytest.raises(ValueError):
        layout.zorder(df, ["a", "b"], 2, bits=40)


def test_a_registered_table_is_never_missing(spark, here):
    """Columns come, the location moves and partitions follow, while the entry stays; only a changed type makes it anew."""
    catalog.ensure_database(spark, "t_gap")
    name, made = "t_gap.parts", []
    kept = spark.sql

    def watched(text, *rest, **more):
        made.append(text.split(" ", 1)[0])
        return kept(text, *rest, **more)

    def version(n, rows, ddl, *parts):
        spark.createDataFrame(rows, ddl).write.partitionBy(*parts).parquet(f"{here}/v{n}")
        catalog.register_table(spark, name, f"{here}/v{n}")
        return sorted((tuple(r) for r in spark.table(name).collect()), key=str)

    ddl = "k int, p string, q int"
    assert version(1, [(1, "a b", 1), (2, "c", 1), (3, None, 2)], ddl, "p", "q") == [(1, "a b", 1), (2, "c", 1), (3, None, 2)]
    spark.sql = watched
    try:
        assert version(2, [(4, "a b", 1), (5, "d'/", 1), (6, None, 2)], ddl, "p", "q") == [(4, "a b", 1), (5, "d'/", 1), (6, None, 2)]
        assert "DROP" not in made and "CREATE" not in made
        wider = version(3, [(7, "a b", 1, 9)], "k int, p string, q int, more int", "p", "q")
        assert "DROP" not in made and wider == [(7, 9, "a b", 1)]
    finally:
        del spark.sql
    assert version(4, [("x", "a b", 1)], "k string, p string, q int", "p", "q") == [("x", "a b", 1)]


def names_of(spark, path, *columns):
    return {r.name: tuple(r[1:]) for r in spark.read.parquet(path).groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name")).agg(
        F.count("*"), *[F.min(c) for c in columns]).collect()}


def test_only_small_files_are_packed(spark, here):
    lineitem(spark).filter("l_orderkey % 2 = 0").coalesce(1).write.parquet(f"{here}/t")
    lineitem(spark).filter("l_orderkey % 2 = 1").repartition(30).write.mode("append").parquet(f"{here}/t")
    before = names_of(spark, f"{here}/t")
    assert compaction.compact_incremental(spark, f"{here}/t", 400_000) == 30
    after = names_of(spark, f"{here}/t")
    large = max(before, key=lambda name: before[name])
    assert large in after and len(after) < 10 and not (set(after) & (set(before) - {large}))
    assert spark.read.parquet(f"{here}/t").exceptAll(lineitem(spark)).count() == 0
    assert spark.read.parquet(f"{here}/t").count() == lineitem(spark).count()
    left = compaction.compact_incremental(spark, f"{here}/t", 400_000)
    assert left < 10 and compaction.compact_incremental(spark, f"{here}/t", 1) == 0
    assert spark.read.parquet(f"{here}/t").count() == lineitem(spark).count()


def test_packing_keeps_folders_and_survives_a_crash(spark, here):
    for _ in range(3):
        rows(spark, 100).withColumn("word", F.lit("a b")).coalesce(1).write.mode("append").partitionBy("part", "word").parquet(f"{here}/p")
    finish, compaction.settle = compaction.settle, lambda *_: None
    try:  # died before the exchange: nothing is seen of it
        compaction.compact_incremental(spark, f"{here}/p", partition_by=["part", "word"])
        assert spark.read.parquet(f"{here}/p").count() == 300 and layout.listing(spark, f"{here}/p").files == 6
    finally:
        compaction.settle = finish
    finish(spark, f"{here}/p")
    table = spark.read.parquet(f"{here}/p")
    assert table.count() == 300 and layout.listing(spark, f"{here}/p").files == 2
    assert {(r.part, r.word): r["count"] for r in table.groupBy("part", "word").count().collect()} == {(0, "a b"): 150, (1, "a b"): 150}
    finish(spark, f"{here}/p")
    assert compaction.compact_incremental(spark, f"{here}/p", partition_by=["part", "word"]) == 0


def test_large_files_are_not_one_task(spark, tmp_path):
    """The query's large files are as many as the table is large; the small ones are packed among themselves."""
    rows = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")
    rows.repartition(12).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = maintenance_queries.compact_incremental(spark, str(tmp_path))
    assert made.count() == rows.count()
    files = made.groupBy(F.col("_metadata.file_path").alias("f"), (F.col("l_returnflag") == "N").alias("n")).count().collect()
    large, packed = ([r for r in files if r.n is n] for n in (True, False))
    assert len({r.f for r in files}) == len(files)  # a file that was large is not rewritten
    assert 1 < len(large) <= 12 and 1 < len(packed) < 60  # of 100


def test_files_follow_what_a_task_sorts(spark, tmp_path):
    """Text that Parquet packs to almost nothing is as long as ever in the memory of the task that sorts it."""
    path = f"{tmp_path}/t"
    same = spark.range(20_000, numPartitions=1).select("id", F.repeat(F.lit("same "), 100).alias("text"), F.array(F.lit("x"), F.lit(None)).alias("a"))
    same.write.parquet(path)
    rows = spark.read.parquet(path)
    assert layout.listing(spark, path).bytes < layout.MEGABYTE
    assert layout.files_for(spark, path, layout.MEGABYTE) == layout.files_for(spark, path, layout.MEGABYTE, rows) == 1
    assert 10 <= layout.files_for(spark, path, layout.MEGABYTE, rows, task_bytes=layout.MEGABYTE) < 20
    assert layout.files_for(spark, path, layout.MEGABYTE, rows.filter("id < 0"), layout.MEGABYTE) == 1
