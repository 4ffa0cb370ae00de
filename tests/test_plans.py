"""Whole jobs on small inputs."""

import json
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.config import LakeConfig
from alluvia.operators import nested
from alluvia.plans import bronze, demo, dimensions, ingest, maintenance, silver
from alluvia.plans.tables import APPENDS, DIMENSIONS, HISTORIES, MESSAGE_TABLES
from alluvia.sinks.messages import write_message_files
from alluvia.sinks.tables import load_appended
from alluvia.sources.streams import stream_messages
from alluvia.streaming.lifecycle import run_in_turn
from tests.test_rows import MATCH_BODIES, STATIC_BODY


def send(spark, here, bodies):
    documents = nested.parse_match_documents(spark.createDataFrame([(b,) for b in bodies], "body string"))
    for kind, messages in ingest.match_messages(documents).items():
        write_message_files(messages, f"{here}/messages/{MESSAGE_TABLES[kind].topic}")


def catch_up(spark, here, lake):
    def source(topic):
        return stream_messages(spark, f"{here}/messages/{topic}")

    kinds = ["match", "participant", "unit"]
    run_in_turn([lambda kind=kind: bronze.bronze_stream(lake, source, kind, every=None) for kind in kinds])
    silver.run_silver(spark, lake, kinds, together=False)


def test_messages_to_silver(spark, here):
    lake = LakeConfig(f"{here}/lake", databases={"bronze": "t_bronze", "silver": "t_silver"})
    send(spark, here, MATCH_BODIES + MATCH_BODIES[:1])
    catch_up(spark, here, lake)
    send(spark, here, [MATCH_BODIES[0].replace('"gameId":1', '"gameId":1,"game_length":9.5'), *MATCH_BODIES[1:3]])
    catch_up(spark, here, lake)

    raw = spark.read.parquet(lake.paths("bronze", "tft_matches").data)
    assert raw.count() == 8 and {"message_key", "kafka_timestamp", "processed_ts", "year"} <= set(raw.columns)

    table = silver.history_table(spark, lake, "match")
    history = table.read()
    assert history.columns == [
        "match_id", "gameId", "game_datetime", "game_length", "game_version", "tft_game_type", "tft_set_core_name",
        "tft_set_number", "surrogate_key", "is_current", "effective_date", "end_date", "hash_key", "processed_ts",
        "year", "month", "day",
    ]
    got = {(r.match_id, r.gameId, r.game_length, r.is_current) for r in history.collect()}
    # A match without match_id is kept under its gameId; the broken document has neither and is dropped.
    assert got == {("M1", 1, None, False), ("M1", 1, 9.5, True), (None, 2, None, True), ("M3", 3, None, True)}
    assert history.count() == 4

    players = load_appended(spark, lake.paths("silver", "tft_match_participants").data)
    assert sorted((r.match_id, r.puuid) for r in players.collect()) == [("M1", "p1"), ("M1", "p1"), ("M1", "p2"), ("M1", "p2")]
    units = load_appended(spark, lake.paths("silver", "tft_participant_units").data)
    assert units.filter("character_id = 'c1'").first().item3 == "c"

    assert len(bronze.register_bronze(spark, lake)) == 3 and len(silver.register_silver(spark, lake)) == 3
    assert spark.sql("SELECT count(*) FROM t_bronze.tft_matches").first()[0] == 8
    assert spark.table("t_silver.tft_matches_scd2").exceptAll(history).count() == 0
    assert spark.sql("SELECT game_length FROM t_silver.tft_matches_scd2 WHERE is_current AND gameId = 1").first()[0] == 9.5
    assert spark.table("t_silver.tft_match_participants").columns == players.columns
    assert silver.register_silver(spark, lake) and bronze.register_bronze(spark, lake)
    assert spark.table("t_bronze.tft_matches").count() == 8


def test_summoner_history(spark, here):
    lake = LakeConfig(f"{here}/lake")
    for points in (5, 5, 8):
        body = json.dumps([{"puuid": "a", "leaguePoints": points}])
        responses = spark.createDataFrame([("gold", "II", body)], "tier string, division string, body string")
        write_message_files(ingest.summoner_messages(responses), f"{here}/messages/tft_summoner")
        bronze.bronze_stream(
            lake, lambda topic: stream_messages(spark, f"{here}/messages/{topic}"), "summoner", None
        ).awaitTermination()
        silver.silver_stream(spark, lake, "summoner", None).awaitTermination()
    rows = silver.history_table(spark, lake, "summoner").read()
    assert sorted((r.leaguepoints, r.is_current) for r in rows.collect()) == [(5, False), (8, True)]
    assert rows.columns == HISTORIES["summoner"].spec.layout


def test_dimensions_from_document_to_catalog(spark, here):
    with open(f"{here}/static.json", "w") as out:
        out.write(STATIC_BODY)
    dimensions.static_to_csv(spark, f"{here}/static.json", f"{here}/csv")
    lake = LakeConfig(f"{here}/lake", databases={"bronze": "t_dims"})
    at = datetime(2024, 1, 2)
    outcome = dimensions.load_dimensions(spark, lake, f"{here}/csv", at=at)
    assert {name: r["count"] for name, r in outcome.items()} == {"units": 2, "items": 3, "traits": 2, "augments": 2}
    assert dimensions.exit_code(outcome) == 0
    units = spark.table("t_dims.tft_units")
    assert units.columns == [*DIMENSIONS["units"].schema.names, "ingestion_timestamp"]
    assert units.filter("unit_name = 'Ahri'").first().ability_desc == "Deal damage"
    # Missing texts are '' in the document's rows and NULL again once read back from CSV.
    assert units.filter("unit_name = 'NoId'").first().unit_id is None
    tables = [spark.table(f"t_dims.{DIMENSIONS[n].table}") for n in ("units", "traits", "items", "augments")]
    summary = demo.dimension_summary(*tables)
    assert tuple(summary["item_kinds"].first()) == (2, 1)
    assert [r.unit_name for r in summary["unit_sample"].collect()] == ["NoId", "Ahri"]
    assert {r.tier: r["count"] for r in summary["augment_tiers"].collect()} == {"Gold": 1, "Silver": 1}

    again = dimensions.load_dimensions(spark, lake, f"{here}/csv", ["units", "items"], at)
    assert again["units"]["path"] != outcome["units"]["path"]


def test_one_bad_dimension_does_not_stop_the_rest(spark, here):
    with open(f"{here}/items.csv", "w") as out:
        out.write("set,item_id\n1,a\n")
    with open(f"{here}/augments.csv", "w") as out:
        out.write("set,augment_id,augment_name,augment_desc,tier,icon,associated_traits\n1,a,b,c,d,e,f\n")
    lake = LakeConfig(f"{here}/lake", databases={"bronze": "t_bad"})
    outcome = dimensions.load_dimensions(spark, lake, here, ["items", "augments", "traits"])
    assert [r["status"] for r in outcome.values()] == ["FAILED", "SUCCESS", "FAILED"]
    assert dimensions.exit_code(outcome) == 1


def test_demo_reports(spark, here):
    lake = LakeConfig(f"{here}/lake")
    rows = [(i, f"User_{i}", "view", a, datetime(2024, 1, 7, 13)) for i, a in enumerate((100, 300, 700, 950, None))]
    ddl = "id int, name string, event_type string, amount int, ingest_ts timestamp"
    spark.createDataFrame(rows, ddl).write.parquet(lake.paths("bronze", demo.EVENTS).data)
    for query in demo.process_events(spark, lake, every=None):
        query.awaitTermination()
    processed = spark.read.parquet(lake.paths("bronze", demo.PROCESSED).data)
    row = processed.filter("id = 0").first()
    assert (row.day_of_week, row.hour_of_day, row.revenue_tier) == (1, 13, "low")
    found = demo.processed_reports(processed)
    assert [r.id for r in found["latest"].collect()] == [4, 3, 2, 1, 0]
    assert {r.revenue_tier: (r["count"], r.avg_amount) for r in found["by_tier"].collect()} == {
        "premium": (2, 950.0), "high": (1, 700.0), "medium": (1, 300.0), "low": (1, 100.0),
    }
    assert found["delay"].first().min_delay > 0
    assert found["by_type_and_tier"].count() == 4
    events = demo.event_reports(processed)
    assert events["total"].first()[0] == 5 and events["by_type"].first()["count"] == 5


def test_optimize_bronze(spark, here):
    lake = LakeConfig(f"{here}/lake", databases={"bronze": "t_optimize"})
    rows = spark.range(2000).select(
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("match_id"), F.col("id").alias("gameId"),
        (F.col("id") % 7).cast("string").alias("puuid"), F.lit(datetime(2024, 1, 1)).alias("processed_ts"),
    )
    for kind in ("match", "participant"):
        path = lake.paths("bronze", MESSAGE_TABLES[kind].table).data
        rows.repartition(12).write.parquet(path)
    outcome = maintenance.optimize_bronze(spark, lake)
    assert outcome.optimized == ["tft_matches", "tft_match_participants"]
    assert outcome.skipped == ["tft_participant_units"] and not outcome.failed
    assert outcome.reports["tft_matches"]["after_num_files"] == 1
    made = spark.read.parquet(lake.paths("bronze", "tft_matches_optimized").data).drop("upto")
    assert made.exceptAll(rows).count() == 0 and made.count() == 2000
    assert maintenance.optimize_bronze(spark, lake).unchanged == ["tft_matches", "tft_match_participants"]
    # What comes later is seen at once, and only it is written by the next run; a column that came is NULL before.
    later = rows.limit(30).withColumn("processed_ts", F.lit(datetime(2024, 1, 2))).withColumn("more", F.lit(1))
    later.write.mode("append").parquet(lake.paths("bronze", "tft_matches").data)
    assert bronze.register_bronze(spark, lake)
    for runs in (1, 2):
        table = spark.table("t_optimize.tft_matches")
        assert (table.count(), table.filter("more = 1").count(), table.select("match_id", "processed_ts").distinct().count()) == (2030, 30, 2030)
        plan = table.filter("more = 1")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("GreaterThan(processed_ts") == 1
        assert runs == 2 or maintenance.optimize_bronze(spark, lake).optimized == ["tft_matches"]
    assert spark.read.parquet(lake.paths("bronze", "tft_matches_optimized").data).groupBy("upto").count().count() == 2
    report = maintenance.optimize_table(
        spark, lake.paths("bronze", "tft_matches").data, f"{here}/compacted"
    )
    assert report.first().files_saved == 12


def test_silver_starts_before_bronze(spark, here):
    lake = LakeConfig(f"{here}/lake")
    silver.run_silver(spark, lake, ["match", "participant", "unit"], together=False)
    assert not silver.history_table(spark, lake, "match").exists()
    send(spark, here, MATCH_BODIES)
    catch_up(spark, here, lake)
    assert silver.history_table(spark, lake, "match").current().count() == 3


def test_a_payload_with_one_more_field(spark, here):
    """Bronze, the catalog, silver histories and silver appends see NULL before and values after."""
    lake = LakeConfig(f"{here}/lake", databases={"bronze": "t_evolve", "silver": "t_evolve_silver"})
    level = T.StructField("server", T.StringType())
    histories = HISTORIES["match"]
    wide = replace(histories, spec=replace(histories.spec, carried=("server",)))
    players = replace(APPENDS["participant"], columns=(*APPENDS["participant"].columns, "server"))

    def deliver(topic_of, body, plan=None):
        rows = spark.createDataFrame([(json.loads(body).get("gameId"), body)], "id int, value string")
        messages = rows.select(F.col("id").cast("string").alias("key"), "value", F.current_timestamp().alias("timestamp"))
        write_message_files(messages, f"{here}/messages/{MESSAGE_TABLES[topic_of].topic}")
        source = lambda topic: stream_messages(spark, f"{here}/messages/{topic}")
        bronze.bronze_stream(lake, source, topic_of, None, plan).awaitTermination()

    for kind, body in (("match", {"gameId": 1, "game_length": 5.0}), ("participant", {"gameId": 1, "puuid": "p"})):
        deliver(kind, json.dumps(body))
    silver.history_stream(spark, lake, "match", None).awaitTermination()
    silver.append_table_stream(spark, lake, "participant", None).awaitTermination()
    assert bronze.register_bronze(spark, lake)
    assert "server" not in spark.table("t_evolve.tft_matches").columns

    tables = {kind: MESSAGE_TABLES[kind].with_fields(level) for kind in ("match", "participant")}
    deliver("match", json.dumps({"gameId": 2, "game_length": 5.0, "server": "eu"}), tables["match"])
    deliver("match", json.dumps({"gameId": 1, "game_length": 6.0, "server": "us"}), tables["match"])
    deliver("participant", json.dumps({"gameId": 2, "puuid": "p", "server": "eu"}), tables["participant"])
    silver.history_stream(spark, lake, "match", None, plan=wide, bronze=tables["match"]).awaitTermination()
    silver.append_table_stream(spark, lake, "participant", None, plan=players, bronze=tables["participant"]).awaitTermination()

    bronze.register_bronze(spark, lake)
    for rows in (spark.table("t_evolve.tft_matches"), spark.read.option("mergeSchema", "true").parquet(lake.paths("bronze", "tft_matches").data)):
        assert sorted((r.gameId, r.game_length, r.server) for r in rows.collect()) == [(1, 5.0, None), (1, 6.0, "us"), (2, 5.0, "eu")]
    history = silver.history_table(spark, lake, "match", wide)
    got = sorted((r.gameId, r.game_length, r.server, r.is_current) for r in history.read().collect())
    assert got == [(1, 5.0, None, False), (1, 6.0, "us", True), (2, 5.0, "eu", True)]
    assert silver.register_silver(spark, lake)
    appended = load_appended(spark, lake.paths("silver", "tft_match_participants").data, evolve=True)
    assert sorted((r.gameId, r.server or "") for r in appended.collect()) == [(1, ""), (2, "eu")]
