"""Tables that are written, registered, replaced and rearranged: the rows must come back the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.operators import layout
from alluvia.queries.registry import query, table
from alluvia.session import shared_folder
from alluvia.sinks import catalog, compaction
from alluvia.sinks.tables import live_version, load_table, overwrite_table

DATABASE = "alluvia_check"


@query("overwrite_table", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def overwrite(spark, folder):
    path = shared_folder(spark, "overwrite")
    orders = table(spark, folder, "orders")
    overwrite_table(orders, path)
    overwrite_table(orders.filter("o_orderstatus <> 'P'"), path, partition_by=["o_orderpriority"])
    return load_table(spark, path)


@query("catalog_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def catalog_roundtrip(spark, folder):
    path = shared_folder(spark, "catalog")
    overwrite_table(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path)
    catalog.ensure_database(spark, DATABASE)
    catalog.register_table(spark, f"{DATABASE}.orders_copy", live_version(spark, path))
    return spark.table(f"{DATABASE}.orders_copy")


@query("insert_overwrite", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def insert_overwrite(spark, folder):
    name = f"{DATABASE}.customer_copy"
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    catalog.ensure_database(spark, DATABASE)
    catalog.create_empty_table(
        spark, name, "c_custkey BIGINT, c_name STRING, c_mktsegment STRING", shared_folder(spark, "insert"),
        {"layer": "bronze"},
    )
    catalog.insert_overwrite(customers.filter("c_custkey < 10"), name)
    catalog.insert_overwrite(customers, name)
    return spark.table(name)


@query("compact_table", "SELECT * FROM lineitem")
def compact_table(spark, folder):
    home = shared_folder(spark, "compact")
    table(spark, folder, "lineitem").repartition(32).write.parquet(f"{home}/small")
    layout.compact(spark, f"{home}/small", f"{home}/large")
    return spark.read.parquet(f"{home}/large")


@query("compact_incremental", "SELECT * FROM lineitem")
def compact_incremental(spark, folder):
    """Large files and many small ones: only the small ones are packed. What is large follows the table's size, up to a bound, and beyond
    it the number of files does; no task reads more than four times the target."""
    path = f"{shared_folder(spark, 'incremental')}/t"
    size = layout.listing(spark, f"{folder}/lineitem.parquet").bytes
    target = min(64 * layout.MEGABYTE, max(layout.MEGABYTE // 4, size // 40))
    rows = table(layout.packing_session(spark, 4 * target), folder, "lineitem")
    rows.filter("l_returnflag = 'N'").write.parquet(path)
    small = max(24, -(-5 * size // (2 * target)))  # so that a target holds two and more
    table(spark, folder, "lineitem").filter("l_returnflag <> 'N'").repartition(small).write.mode("append").parquet(path)
    compaction.compact_incremental(spark, path, target)
    return spark.read.parquet(path)


@query("file_sizes", "SELECT count(*) AS \"rows\", 24 AS files, true AS bytes_fit FROM lineitem")
def file_sizes(spark, folder):
    """Rows and bytes of every file from footers, against the listing."""
    path = f"{shared_folder(spark, 'sizes')}/t"
    table(spark, folder, "lineitem").repartition(24).write.parquet(path)
    return layout.file_sizes(spark, path).agg(
        F.sum("rows").alias("rows"), F.count("*").cast("int").alias("files"),
        (F.sum("bytes") == layout.listing(spark, path).bytes).alias("bytes_fit"))


@query("zorder_cluster", "SELECT * FROM lineitem")
def zorder_cluster(spark, folder):
    path = shared_folder(spark, "zorder")
    rows = table(spark, folder, "lineitem")
    files = layout.files_for(spark, f"{folder}/lineitem.parquet", target_bytes=layout.MEGABYTE)
    layout.zorder(rows, ["l_orderkey", "l_partkey"], files).write.parquet(path)
    return spark.read.parquet(path)


@query("file_report", """
    SELECT count(*) AS rows_before, count(*) AS rows_after, true AS fewer_files, true AS files_saved_pct_fits FROM lineitem""")
def file_report(spark, folder):
    """Many small files against their compacted copy: no row is lost, and the report is about the files there are."""
    home = shared_folder(spark, "report")
    table(spark, folder, "lineitem").repartition(24).write.parquet(f"{home}/small")
    layout.compact(spark, f"{home}/small", f"{home}/large")
    report = layout.compare_stats(layout.table_stats(spark, f"{home}/small"), layout.table_stats(spark, f"{home}/large"))
    sides = [spark.read.parquet(f"{home}/{name}").select(F.lit(name).alias("side")) for name in ("small", "large")]
    counted = sides[0].union(sides[1]).agg(
        F.count_if(F.col("side") == "small").alias("rows_before"), F.count_if(F.col("side") == "large").alias("rows_after"))
    saved = F.round(100.0 * (F.col("before_num_files") - F.col("after_num_files")) / F.col("before_num_files"), 2)
    told = report.select(
        (F.col("after_num_files") < F.col("before_num_files")).alias("fewer_files"),
        (F.col("files_saved_pct") == saved).alias("files_saved_pct_fits"))
    both = counted.unionByName(told, allowMissingColumns=True)  # two rows, each with half of the columns
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
