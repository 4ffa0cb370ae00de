"""The game tables end to end: documents to messages, bronze streams and silver streams, twice in a row.

Orders play the matches and customers the players. The second delivery holds every fifth order with another
game type, resends every seventh as it was, and leaves the rest out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.config import LakeConfig
from alluvia.operators import nested
from alluvia.plans import bronze, ingest, maintenance, silver
from alluvia.plans.tables import APPENDS, HISTORIES, MESSAGE_TABLES
from alluvia.queries.nested import league_responses, match_documents
from alluvia.queries.registry import query, spread, table
from alluvia.session import shared_folder
from alluvia.sinks.messages import write_message_files
from alluvia.sinks.tables import load_appended
from alluvia.sources.streams import stream_messages

BUCKETS = 4  # the game tables are small
FIRST, SECOND = "TIMESTAMP_NTZ '2024-02-01 00:00:00'", "TIMESTAMP_NTZ '2024-02-02 00:00:00'"


class Delivery:
    """A lake in a fresh folder, filled by message files."""

    def __init__(self, spark, database="alluvia_lake"):
        self.spark = spark
        self.home = shared_folder(spark, "lake")
        self.config = LakeConfig(f"{self.home}/lake", databases={"bronze": database}, key_buckets=BUCKETS)

    def messages(self, topic):
        return stream_messages(self.spark, f"{self.home}/messages/{topic}")

    def deliver(self, kind, messages, at=None):
        """Write the messages, and let the bronze and silver streams catch up."""
        write_message_files(messages, f"{self.home}/messages/{MESSAGE_TABLES[kind].topic}")
        bronze.bronze_stream(self.config, self.messages, kind, every=None).awaitTermination()
        if at is None:
            return
        start = silver.history_stream if kind in HISTORIES else silver.append_table_stream
        # One micro-batch per delivery at any scale, so that copies of a message always meet in it.
        start(
            self.spark, self.config, kind, every=None, max_bytes=None, batch_time=lambda batch, number: F.expr(at)
        ).awaitTermination()


def match_messages(orders):
    """Messages on matches; the participants in the documents are passed over."""
    return ingest.header_messages(nested.parse_match_documents(match_documents(orders), header_only=True))


def participant_messages(orders):
    return ingest.match_messages(nested.parse_match_documents(match_documents(orders)))["participant"]


def order_rows(spark, folder):
    """Orders in tasks of about 60,000, as each becomes a document."""
    return spread(spark, folder, "orders", "o_orderkey", 1024 * 1024)


@query("lake_bronze_matches", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_key, 'VN2_' || o_orderkey AS match_id, o_orderkey AS "gameId",
           CAST(epoch_ms(o_orderdate) AS DOUBLE) AS game_datetime, o_totalprice AS game_length,
           o_orderstatus AS tft_game_type
    FROM orders""")
def lake_bronze_matches(spark, folder):
    lake = Delivery(spark)
    lake.deliver("match", match_messages(order_rows(spark, folder)))
    rows = spark.read.parquet(lake.config.paths("bronze", MESSAGE_TABLES["match"].table).data)
    return rows.select("message_key", "match_id", "gameId", "game_datetime", "game_length", "tft_game_type")


@query("lake_match_history", """
    WITH opened AS (
        SELECT *, TIMESTAMP '2024-02-01' AS effective_date,
               CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2024-02-02' END AS end_date FROM orders
        UNION ALL
        SELECT * REPLACE ('X' AS o_orderstatus), TIMESTAMP '2024-02-02', NULL FROM orders WHERE o_orderkey % 5 = 0)
    SELECT 'VN2_' || o_orderkey AS match_id, o_orderkey AS "gameId", CAST(epoch_ms(o_orderdate) AS DOUBLE) AS game_datetime,
           o_totalprice AS game_length, o_orderpriority AS game_version, o_orderstatus AS tft_game_type,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS tft_set_core_name,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tft_set_number,
           effective_date, end_date, end_date IS NULL AS is_current, effective_date AS processed_ts,
           2024 AS "year", 2 AS "month", CAST(day(effective_date) AS INTEGER) AS "day"
    FROM opened""")
def lake_match_history(spark, folder):
    lake, orders = Delivery(spark), order_rows(spark, folder)
    lake.deliver("match", match_messages(orders), FIRST)
    changed = F.col("o_orderkey") % 5 == 0
    again = orders.filter(changed | (F.col("o_orderkey") % 7 == 0)).withColumn(
        "o_orderstatus", F.when(changed, "X").otherwise(F.col("o_orderstatus"))
    )
    lake.deliver("match", match_messages(again), SECOND)
    history = silver.history_table(spark, lake.config, "match").read()
    return history.select(
        "match_id", "gameId", "game_datetime", "game_length", "game_version", "tft_game_type", "tft_set_core_name", "tft_set_number",
        "effective_date", "end_date", "is_current", "processed_ts", "year", "month", "day",
    )


@query("lake_participants", """
    SELECT 'VN2_' || o_orderkey AS match_id, o_orderkey AS "gameId", o_custkey || '-' || i AS puuid,
           CAST(i AS INTEGER) AS placement, CAST((o_orderkey + i) % 50 AS INTEGER) AS gold_left,
           TIMESTAMP '2024-02-01' AS processed_ts, 2024 AS "year", 2 AS "month", 1 AS "day"
    FROM orders, unnest(generate_series(1, CAST(substr(o_orderpriority, 1, 1) AS INTEGER))) AS p(i)
    WHERE o_orderstatus <> 'P'""")
def lake_participants(spark, folder):
    """Every message is delivered twice; the micro-batch keeps one of each."""
    lake = Delivery(spark)
    messages = participant_messages(order_rows(spark, folder))
    lake.deliver("participant", messages.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy"), FIRST)
    rows = load_appended(spark, lake.config.paths("silver", APPENDS["participant"].table).data)
    return rows.select(
        "match_id", "gameId", "puuid", "placement", "gold_left", "processed_ts", "year", "month", "day"
    )


@query("lake_summoner_history", """
    WITH opened AS (
        SELECT *, c_nationkey AS points, TIMESTAMP '2024-02-01' AS effective_date,
               CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2024-02-02' END AS end_date FROM customer
        UNION ALL
        SELECT *, c_nationkey + 1 AS points, TIMESTAMP '2024-02-02', NULL FROM customer WHERE c_custkey % 3 = 0),
    blanks AS (
        SELECT effective_date, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CHALLENGER' WHEN 'BUILDING' THEN 'MASTER'
                   WHEN 'FURNITURE' THEN 'GRANDMASTER' WHEN 'HOUSEHOLD' THEN 'GOLD' ELSE 'IRON' END AS tier,
               CASE WHEN points % 2 = 0 THEN 'II' ELSE 'I' END AS "rank", CAST(c_custkey % 100 AS INTEGER) AS wins
        FROM opened WHERE c_custkey % 10 <> 0),
    last_blanks AS (
        SELECT * FROM blanks
        QUALIFY row_number() OVER (PARTITION BY effective_date ORDER BY tier DESC, "rank" DESC, wins DESC) = 1),
    changed_blanks AS (
        SELECT * FROM last_blanks
        QUALIFY (tier, "rank", wins) IS DISTINCT FROM lag((tier, "rank", wins)) OVER (ORDER BY effective_date)),
    blank_versions AS (
        SELECT '' AS puuid, 'VN2' AS region, tier, "rank", 0 AS leaguepoints, wins, 0 AS losses, effective_date,
               lead(effective_date) OVER (ORDER BY effective_date) AS end_date,
               lead(effective_date) OVER (ORDER BY effective_date) IS NULL AS is_current
        FROM changed_blanks)
    SELECT c_name AS puuid, 'VN2' AS region, 'OWN' AS tier, 'IV' AS "rank", points AS leaguepoints,
           CAST(c_custkey % 100 AS INTEGER) AS wins, 0 AS losses, effective_date, end_date, end_date IS NULL AS is_current
    FROM opened WHERE c_custkey % 10 <> 0
    UNION ALL SELECT * FROM blank_versions""")
def lake_summoner_history(spark, folder):
    """All entries first; then every third player has won a point.

    Half of the entries have no player id: they share one key, and are one player, whose last entry is the greatest in
    all other columns.
    """
    lake, customers = Delivery(spark), table(spark, folder, "customer")
    better = customers.filter("c_custkey % 3 = 0").withColumn("c_nationkey", F.col("c_nationkey") + 1)
    for answers, at in ((customers, FIRST), (better, SECOND)):
        lake.deliver("summoner", ingest.summoner_messages(league_responses(answers)), at)
    history = silver.history_table(spark, lake.config, "summoner").read()
    return history.select(
        "puuid", "region", "tier", "rank", "leaguepoints", "wins", "losses", "effective_date", "end_date", "is_current"
    )


@query("lake_optimized", """
    SELECT 'VN2_' || o_orderkey AS match_id, o_orderkey AS "gameId", o_orderstatus AS tft_game_type FROM orders
    UNION ALL SELECT 'VN2_' || o_orderkey, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END
    FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0""")
def lake_optimized(spark, folder):
    """The bronze table as the catalog shows it: optimized after the first delivery, with the second read from where it fell."""
    lake, orders = Delivery(spark, "alluvia_optimized"), order_rows(spark, folder)
    lake.deliver("match", match_messages(orders))
    outcome = maintenance.optimize_bronze(spark, lake.config, ["match"])
    if outcome.failed:
        raise RuntimeError(outcome.failed)
    changed = F.col("o_orderkey") % 5 == 0
    again = orders.filter(changed | (F.col("o_orderkey") % 7 == 0)).withColumn(
        "o_orderstatus", F.when(changed, "X").otherwise(F.col("o_orderstatus")))
    lake.deliver("match", match_messages(again))
    bronze.register_bronze(spark, lake.config)  # this session has listed the files before, as of any external table
    return spark.table(lake.config.paths("bronze", MESSAGE_TABLES["match"].table).name).select("match_id", "gameId", "tft_game_type")
