"""Nested documents, one per order, and league responses, one per customer.

Each document is built from a single table row, so packing needs no grouping and no document can grow
beyond its row: the participants are as many as the order's priority digit (none for status 'P').
"""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.operators import nested
from alluvia.operators.league import summoner_rows
from alluvia.queries.registry import query, table


def match_documents(orders):
    """JSON match documents (column ``body``) from orders."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    players = F.substring("o_orderpriority", 1, 1).cast("int")
    epoch_ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', o_orderdate)")

    def unit(i, j):
        return F.struct(
            F.concat(F.lit("unit"), j).alias("character_id"),
            ((key + j) % 3 + 1).cast("int").alias("tier"),
            F.slice(F.array(F.lit("sword"), F.lit("bow"), F.lit("rod"), F.lit("tear")), 1, (key + i + j) % 5)
            .alias("itemNames"),
        )

    def player(i):
        return F.struct(
            F.concat_ws("-", "o_custkey", i).alias("puuid"),
            i.alias("placement"),
            ((key + i) % 50).cast("int").alias("gold_left"),
            (20 + (key * i) % 30).cast("int").alias("last_round"),
            ((key + i) % 10).cast("int").alias("level"),
            ((key * i) % 8).cast("int").alias("players_eliminated"),
            ((key * 7 + i) % 200).cast("int").alias("total_damage_to_players"),
            F.transform(F.filter(F.array(F.lit(1), F.lit(2)), lambda j: j <= i % 3), lambda j: unit(i, j))
            .alias("units"),
        )

    info = F.struct(
        key.alias("gameId"),
        epoch_ms.cast("double").alias("game_datetime"),
        F.col("o_totalprice").alias("game_length"),
        F.col("o_orderpriority").alias("game_version"),
        status.alias("tft_game_type"),
        F.when(status != "O", F.col("o_orderpriority")).alias("tft_set_core_name"),
        players.alias("tft_set_number"),
        F.when(status != "P", F.transform(F.sequence(F.lit(1), players), player)).alias("participants"),
    )
    metadata = F.struct(F.concat(F.lit("VN2_"), key.cast("string")).alias("match_id"))
    document = F.struct(metadata.alias("metadata"), info.alias("info"))
    return orders.select(F.to_json(document).alias("body"))


def parsed(spark, folder, header_only=False):
    return nested.parse_match_documents(match_documents(table(spark, folder, "orders")), header_only=header_only)


@query("nested_header", """
    SELECT 'VN2_' || o_orderkey AS match_id, o_orderkey AS "gameId", CAST(epoch_ms(o_orderdate) AS DOUBLE) AS game_datetime,
           o_totalprice AS game_length, o_orderpriority AS game_version, o_orderstatus AS tft_game_type,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS tft_set_core_name,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tft_set_number
    FROM orders""")
def nested_header(spark, folder):
    return nested.match_rows(parsed(spark, folder, header_only=True))


PLAYERS_SQL = """
    FROM orders, unnest(generate_series(1, CAST(substr(o_orderpriority, 1, 1) AS INTEGER))) AS p(i)"""


@query("nested_explode", f"""
    SELECT 'VN2_' || o_orderkey AS match_id, o_orderkey AS "gameId", o_custkey || '-' || i AS puuid,
           CAST(i AS INTEGER) AS placement, CAST((o_orderkey + i) % 50 AS INTEGER) AS gold_left,
           CAST(20 + (o_orderkey * i) % 30 AS INTEGER) AS last_round, CAST((o_orderkey + i) % 10 AS INTEGER) AS level,
           CAST((o_orderkey * i) % 8 AS INTEGER) AS players_eliminated,
           CAST((o_orderkey * 7 + i) % 200 AS INTEGER) AS total_damage_to_players
    {PLAYERS_SQL} WHERE o_orderstatus <> 'P'""")
def nested_explode(spark, folder):
    return nested.participant_rows(parsed(spark, folder))


@query("nested_explode2", f"""
    SELECT 'VN2_' || o_orderkey AS match_id, o_orderkey AS "gameId", o_custkey || '-' || i AS puuid,
           'unit' || j AS character_id, CAST((o_orderkey + j) % 3 + 1 AS INTEGER) AS tier,
           CASE WHEN (o_orderkey + i + j) % 5 >= 1 THEN 'sword' END AS item1,
           CASE WHEN (o_orderkey + i + j) % 5 >= 2 THEN 'bow' END AS item2,
           CASE WHEN (o_orderkey + i + j) % 5 >= 3 THEN 'rod' END AS item3
    {PLAYERS_SQL}, unnest(generate_series(1, i % 3)) AS u(j) WHERE o_orderstatus <> 'P'""")
def nested_explode2(spark, folder):
    return nested.unit_rows(parsed(spark, folder))


@query("league_normalize", """
    WITH asked AS (
        SELECT *, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CHALLENGER' WHEN 'BUILDING' THEN 'Master'
                  WHEN 'FURNITURE' THEN 'GRANDMASTER' WHEN 'HOUSEHOLD' THEN 'GOLD' ELSE 'iron' END AS tier FROM customer)
    SELECT CASE WHEN n = 2 THEN '' ELSE c_name END AS puuid, 'VN2' AS region,
           CASE WHEN n = 1 THEN 'OWN' ELSE upper(tier) END AS tier,
           CASE WHEN n = 1 THEN 'IV' WHEN c_nationkey % 2 = 0 THEN 'II' ELSE 'I' END AS "rank",
           CASE WHEN n = 1 THEN c_nationkey ELSE 0 END AS "leaguePoints", CAST(c_custkey % 100 AS INTEGER) AS wins,
           0 AS losses, TIMESTAMP '2024-02-01 00:00:00' AS ingest_ts
    FROM asked, unnest([1, 2]) AS e(n) WHERE c_custkey % 10 <> 0""")
def league_normalize(spark, folder):
    return summoner_rows(league_responses(table(spark, folder, "customer")), F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'"))


def league_responses(customers):
    """Customers answer as league entries: the full one and one with most fields missing. Every tenth
    response has the shape of the other kind of tier, and is skipped."""
    segments = {"AUTOMOBILE": "CHALLENGER", "BUILDING": "Master", "FURNITURE": "GRANDMASTER", "HOUSEHOLD": "GOLD"}
    tier = F.lit("iron")
    for segment, name in segments.items():
        tier = F.when(F.col("c_mktsegment") == segment, name).otherwise(tier)
    wins = (F.col("c_custkey") % 100).cast("int").alias("wins")
    missing = F.lit(None).cast("string")
    entries = F.array(
        F.struct(
            F.col("c_name").alias("puuid"), F.lit("OWN").alias("tier"), F.lit("IV").alias("rank"),
            F.col("c_nationkey").alias("leaguePoints"), wins,
        ),
        F.struct(
            missing.alias("puuid"), missing.alias("tier"), missing.alias("rank"),
            missing.cast("int").alias("leaguePoints"), wins,
        ),
    )
    asked = customers.withColumn("tier", tier)
    is_page = F.lower("tier").isin("challenger", "master", "grandmaster") != (F.col("c_custkey") % 10 == 0)
    return asked.select(
        "tier",
        F.when(F.col("c_nationkey") % 2 == 0, "II").otherwise("").alias("division"),
        F.when(is_page, F.to_json(F.struct(F.upper("tier").alias("tier"), entries.alias("entries"))))
        .otherwise(F.to_json(entries)).alias("body"),
    )
