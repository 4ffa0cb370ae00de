"""Text rules, arrays, hashes, sorting and keys on ``part``, ``orders``, ``lineitem`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.functions import (
    array_text, contains_any, element_columns, first_label, leading_number, row_hash, safe_size, strip_markup,
)
from alluvia.functions.hashing import surrogate_key
from alluvia.operators import envelope, reports, rows
from alluvia.queries.registry import query, table
from alluvia.session import shared_folder
from alluvia.sinks.messages import write_message_files
from alluvia.sinks.tables import ensure_table, load_table, upsert_table
from alluvia.sources.files import read_documents, read_lines

TERMS = ["ring", "bolt", "gizmo"]
WORD_RULES = [("Silver", ["small", "SILVER"]), ("Gold", ["red", "ring"]), ("Prismatic", ["old", "bolt"])]


@query("sort_multi", "SELECT p_size, p_retailprice, p_name, p_partkey FROM part")
def sort_multi(spark, folder):
    parts = table(spark, folder, "part").select("p_size", "p_retailprice", "p_name", "p_partkey")
    return reports.sorted_rows(parts, ["p_size", "p_name"])


@query("filter_head", """
    SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size = 14 ORDER BY p_partkey LIMIT 10""")
def filter_head(spark, folder):
    chosen = table(spark, folder, "part").filter("p_size = 14").select("p_partkey", "p_name", "p_retailprice")
    return reports.top_rows(chosen, ["p_partkey"], 10, descending=False)


@query("value_counts", """
    SELECT l_returnflag, count(*) AS "count" FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1""")
def value_counts(spark, folder):
    return reports.value_counts(table(spark, folder, "lineitem"), "l_returnflag")


@query("distinct_sorted", "SELECT DISTINCT p_size FROM part WHERE p_size IS NOT NULL")
def distinct_sorted(spark, folder):
    return reports.distinct_sorted(table(spark, folder, "part"), "p_size")


@query("agg_count_if", """
    SELECT count(*) FILTER (l_quantity < 10) AS small, count(*) FILTER (l_discount = 0) AS undiscounted
    FROM lineitem""")
def agg_count_if(spark, folder):
    tests = {"small": F.col("l_quantity") < 10, "undiscounted": F.col("l_discount") == 0}
    return reports.conditional_counts(table(spark, folder, "lineitem"), tests)


@query("html_clean", r"""
    SELECT page_id, coalesce(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
           '[\s\p{Z}\x0B\x1C-\x1F\x{85}]+', ' ', 'g')), '') AS body
    FROM pages""")
def html_clean(spark, folder):
    return table(spark, folder, "pages").select("page_id", strip_markup(F.col("html")).alias("body"))


@query("regex_capture_int", """
    SELECT p_partkey, nullif(TRY_CAST(nullif(regexp_extract(p_brand, '^Brand#([0-9]+)', 1), '') AS INTEGER), 0)
           AS brand_number
    FROM part""")
def regex_capture_int(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", leading_number(F.col("p_brand"), "Brand#").alias("brand_number")
    )


@query("exclude_terms", """
    SELECT p_partkey, p_name FROM part
    WHERE NOT (lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%bolt%' OR lower(p_name) LIKE '%gizmo%')""")
def exclude_terms(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return rows.excluding(parts, contains_any(F.col("p_name"), TERMS))


@query("route_by_term", """
    SELECT p_partkey, CASE WHEN p_type LIKE '%PROMO%' THEN 'promoted' ELSE 'regular' END AS route FROM part""")
def route_by_term(spark, folder):
    promoted, regular = rows.routed(table(spark, folder, "part"), F.col("p_type").contains("PROMO"))
    return promoted.select("p_partkey", F.lit("promoted").alias("route")).unionByName(
        regular.select("p_partkey", F.lit("regular").alias("route"))
    )


@query("classify_terms", """
    SELECT p_partkey, CASE
        WHEN lower(p_name) LIKE '%small%' OR lower(p_name) LIKE '%silver%' THEN 'Silver'
        WHEN lower(p_name) LIKE '%red%' OR lower(p_name) LIKE '%ring%' THEN 'Gold'
        WHEN lower(p_name) LIKE '%old%' OR lower(p_name) LIKE '%bolt%' THEN 'Prismatic'
        ELSE 'Unknown' END AS tier
    FROM part""")
def classify_terms(spark, folder):
    label = first_label(F.col("p_name"), WORD_RULES, "Unknown")
    return table(spark, folder, "part").select("p_partkey", label.alias("tier"))


@query("array_to_columns", """
    SELECT page_id, parts[1] AS part1, parts[2] AS part2, parts[3] AS part3,
           coalesce(parts[1], '') AS filled1, coalesce(parts[2], '') AS filled2, coalesce(parts[3], '') AS filled3,
           coalesce(parts[4], '') AS filled4, len(parts) AS n, array_to_string(parts, ', ') AS joined
    FROM (SELECT page_id, string_split(regexp_replace(url, '^https?://', ''), '/') AS parts FROM pages)""")
def array_to_columns(spark, folder):
    parts = F.split(F.regexp_replace("url", "^https?://", ""), "/")
    pages = table(spark, folder, "pages").select("page_id", parts.alias("parts"))
    return pages.select(
        "page_id",
        *element_columns(F.col("parts"), "part", 3),
        *element_columns(F.col("parts"), "filled", 4, fill=""),
        safe_size(F.col("parts")).cast("bigint").alias("n"),
        array_text(F.col("parts")).alias("joined"),
    )


@query("row_hash", """
    SELECT o_orderkey, sha256(concat_ws('||', coalesce(CAST(o_custkey AS VARCHAR), ''), coalesce(o_orderstatus, ''),
           coalesce(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), ''), coalesce(o_orderpriority, '')))
           AS hash_key
    FROM orders""")
def row_hash_query(spark, folder):
    orders = table(spark, folder, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    tracked = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return orders.select("o_orderkey", row_hash(tracked).alias("hash_key"))


@query("dedup_in_batch", """
    SELECT * EXCLUDE (pick) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
            l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
            l_linestatus DESC) AS pick
        FROM lineitem)
    WHERE pick = 1""")
def dedup_in_batch(spark, folder):
    return rows.dedup_batch(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("keyed_json_sink", """
    SELECT o_orderkey || '_' || o_custkey || '_' || coalesce(nullif(o_orderstatus, 'P'), 'None') AS message_key,
           o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_totalprice
    FROM orders""")
def keyed_json_sink(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice"
    )
    key = envelope.message_key([F.col("o_orderkey"), F.col("o_custkey"), F.col("status")])
    written = write_message_files(envelope.to_messages(orders, key), shared_folder(spark, "messages"))
    messages = spark.read.schema("key STRING, value STRING").json(written)
    return envelope.decode_messages(messages, orders.schema, arrival=False)


@query("line_list_scan", "SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders WHERE o_orderkey % 3 <> 0")
def line_list_scan(spark, folder):
    # Each order writes its key with stray blanks, twice, next to a blank line; every third one is commented out.
    key = F.col("o_orderkey")
    text = F.concat(F.when(key % 3 == 0, "# ").otherwise("  "), key.cast("string"), F.lit("\t"))
    lines = table(spark, folder, "orders").select(
        F.explode(F.array(text, F.lit("   "), text)).alias("value")
    )
    path = shared_folder(spark, "lines")
    lines.write.text(path)
    return read_lines(spark, path, unique=True)


@query("versioned_keys", """
    SELECT o_orderkey, o_orderkey || '_' || o_orderstatus || '_' || o_orderpriority || '_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS key
    FROM orders""")
def versioned_keys(spark, folder):
    named = table(spark, folder, "orders").withColumn("puuid", F.col("o_orderkey").cast("string"))
    key = envelope.summoner_key(F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate"))
    return named.select("o_orderkey", key.alias("key"))


@query("surrogate_keys", """
    WITH p AS (SELECT o_orderkey, o_orderkey::VARCHAR AS a, coalesce(nullif(o_orderstatus, 'P'), 'None') AS b,
                      strftime(o_orderdate, '%Y%m%d%H%M%S000') AS moment FROM orders)
    SELECT o_orderkey, a || '_' || b || '_' || moment || '_' || substr(sha256(a || '||' || b || '||' || moment), 1, 16) AS surrogate_key FROM p""")
def surrogate_keys(spark, folder):
    orders = table(spark, folder, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return orders.select("o_orderkey", surrogate_key(["o_orderkey", "status"], F.col("o_orderdate")).alias("surrogate_key"))


@query("document_scan", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def document_scan(spark, folder):
    """Files that are one JSON array each, spread over lines: one row per element."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = shared_folder(spark, "documents")
    bodies = orders.groupBy((F.col("o_orderkey") % F.lit(16)).alias("part"), F.floor(F.col("o_orderkey") / 4000).alias("block")).agg(
        F.to_json(F.collect_list(F.struct(*orders.columns)), {"pretty": "true"}).alias("body"))
    bodies.select("body").write.option("maxRecordsPerFile", 1).text(path)
    return read_documents(spark, path, orders.schema)


@query("ensure_then_upsert", """
    SELECT c_custkey, c_name, true AS was_empty FROM customer""")
def ensure_then_upsert(spark, folder):
    """A table that is created empty, found empty, and then filled."""
    path, customers = shared_folder(spark, "ensured"), table(spark, folder, "customer").select("c_custkey", "c_name")
    ensure_table(spark, path, customers.schema)
    was_empty = load_table(spark, path).isEmpty()
    upsert_table(customers, path, ["c_custkey"])
    return load_table(spark, path).withColumn("was_empty", F.lit(was_empty))
