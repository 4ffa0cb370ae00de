"""Change detection and upserts: stored orders against an altered slice of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.functions import row_hash
from alluvia.operators import changes, rows, sketch
from alluvia.queries.registry import query, table
from alluvia.session import shared_folder
from alluvia.sinks.tables import live_version, overwrite_table, upsert_table
from alluvia.sinks.upserts import UpsertTable

TRACKED = ["o_orderstatus", "amount", "o_orderpriority"]
KEYS = ["o_orderkey", "o_custkey"]
STORED_UNTIL, INCOMING_FROM = "2000-01-01", "1999-01-01"

# Orders before 2000 are stored. Those since 1999 come in, and every fifth of them has another status.
ORDERS_SQL = """
    base AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
                    o_orderpriority, o_orderdate FROM orders),
    stored AS (SELECT *, sha256(concat_ws('||', o_orderstatus, CAST(amount AS VARCHAR), o_orderpriority)) AS hash_key
               FROM base WHERE o_orderdate < TIMESTAMP '2000-01-01'),
    altered AS (SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
                FROM base WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
    incoming AS (SELECT *, sha256(concat_ws('||', o_orderstatus, CAST(amount AS VARCHAR), o_orderpriority)) AS hash_key
                 FROM altered),
    shown_stored AS (SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM stored),
    shown_incoming AS (SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM incoming)"""


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        "o_orderpriority", "o_orderdate",
    )


def shown(df):
    """Amounts are decimals for the hash, and doubles in the result."""
    return df.withColumn("amount", F.col("amount").cast("double"))


def stored_orders(spark, folder):
    old = _orders(spark, folder).filter(F.col("o_orderdate") < F.lit(STORED_UNTIL).cast("timestamp_ntz"))
    return old.withColumn("hash_key", row_hash(TRACKED))


def incoming_orders(spark, folder):
    recent = _orders(spark, folder).filter(F.col("o_orderdate") >= F.lit(INCOMING_FROM).cast("timestamp_ntz"))
    status = F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus"))
    return recent.withColumn("o_orderstatus", status).withColumn("hash_key", row_hash(TRACKED))


@query("current_for_batch", f"""
    WITH {ORDERS_SQL}
    SELECT * FROM shown_stored s WHERE EXISTS (
        SELECT 1 FROM incoming i WHERE i.o_orderkey = s.o_orderkey AND i.o_custkey = s.o_custkey)""")
def current_for_batch(spark, folder):
    return shown(changes.current_for_batch(stored_orders(spark, folder), incoming_orders(spark, folder), KEYS))


@query("change_detect", f"""
    WITH {ORDERS_SQL}
    SELECT i.*, CASE WHEN s.hash_key IS NULL THEN 'new' ELSE 'changed' END AS "change"
    FROM shown_incoming i LEFT JOIN stored s USING (o_orderkey, o_custkey)
    WHERE s.hash_key IS NULL OR s.hash_key <> i.hash_key""")
def change_detect(spark, folder):
    return shown(changes.change_detect(incoming_orders(spark, folder), stored_orders(spark, folder), KEYS))


@query("changed_and_new", f"""
    WITH {ORDERS_SQL}
    SELECT i.* FROM shown_incoming i LEFT JOIN stored s USING (o_orderkey, o_custkey)
    WHERE s.hash_key IS NULL OR s.hash_key <> i.hash_key""")
def changed_and_new(spark, folder):
    stored, incoming = stored_orders(spark, folder), incoming_orders(spark, folder)
    return shown(changes.stack(
        changes.changed_rows(incoming, stored, KEYS), changes.new_rows(incoming, stored, KEYS)
    ))


@query("new_keys", f"""
    WITH {ORDERS_SQL}
    SELECT * FROM shown_incoming i WHERE NOT EXISTS (
        SELECT 1 FROM stored s WHERE i.o_orderkey = s.o_orderkey AND i.o_custkey = s.o_custkey)""")
def new_keys(spark, folder):
    return shown(changes.new_rows(incoming_orders(spark, folder), stored_orders(spark, folder), KEYS))


UNSEEN_SQL = """
    SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"""


@query("unseen_ids", UNSEEN_SQL)
def unseen_ids(spark, folder):
    wanted = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return rows.unseen_ids(wanted, stored_orders(spark, folder), ["o_orderkey"])


@query("unseen_ids_sketched", UNSEEN_SQL)
def unseen_ids_sketched(spark, folder):
    """The same ids by way of a Bloom sketch of the stored ones, merged from the sketches of two deliveries."""
    key = ["o_orderkey"]
    wanted = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    stored = stored_orders(spark, folder).select(*key, "o_orderstatus")
    shape = sketch.Shape.for_keys(stored.count())
    done = F.col("o_orderstatus") == "F"
    built = sketch.merged(*(sketch.sketch(part, key, shape) for part in rows.routed(stored, done)))
    return sketch.unseen_by_sketch(wanted, stored, key, built, shape)


UPSERT_SQL = f"""
    WITH {ORDERS_SQL}
    SELECT * FROM shown_incoming UNION ALL
    SELECT * FROM shown_stored s WHERE NOT EXISTS (
        SELECT 1 FROM incoming i WHERE i.o_orderkey = s.o_orderkey AND i.o_custkey = s.o_custkey)"""


@query("upsert_merge", UPSERT_SQL)
def upsert_merge(spark, folder):
    return shown(changes.upsert_merge(stored_orders(spark, folder), incoming_orders(spark, folder), KEYS))


@query("upsert_table", UPSERT_SQL)
def upsert_into_table(spark, folder):
    path = shared_folder(spark, "upsert")
    overwrite_table(stored_orders(spark, folder), path)
    upsert_table(incoming_orders(spark, folder), path, KEYS)
    return shown(spark.read.parquet(live_version(spark, path)))


@query("upsert_batches", UPSERT_SQL)
def upsert_batches(spark, folder):
    """The same upsert into a table of key buckets, where it rewrites those of its keys."""
    stored = UpsertTable(spark, shared_folder(spark, "upserts"), KEYS, 4)
    stored.upsert(stored_orders(spark, folder))
    stored.upsert(incoming_orders(spark, folder))
    return shown(stored.read())
