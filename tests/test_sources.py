import os
from datetime import datetime
from glob import glob

import pytest
from pyspark.sql import functions as F

from alluvia.config import LakeConfig
from alluvia.operators.envelope import decode_messages, match_key, participant_key, summoner_key, to_messages
from alluvia.schemas import ITEMS_CSV, MATCH, TRAITS_CSV, record, STRING, INT
from alluvia.session import PROFILES, profile_settings, shared_folder
from alluvia.sinks import messages as message_files
from alluvia.sinks.messages import write_csv
from alluvia.sources.files import read_csv_strict, read_documents, read_lines
from alluvia.sources.streams import events_from_rate, read_rate_events, stream_messages, stream_table, topic_options
from alluvia.streaming.sinks import append_stream


def test_lake_paths():
    lake = LakeConfig("s3a://lake/", {"silver": "s3a://silver/"}, {"bronze": "s3a://state/b"}, {"gold": "marts"})
    assert lake.paths("Bronze", "t").data == "s3a://lake/bronze/t"
    assert lake.paths("bronze", "t").checkpoint == "s3a://state/b/t"
    assert lake.paths("silver", "t").checkpoint == "s3a://silver/checkpoints/t"
    assert lake.paths("gold", "t").name == "marts.t"
    with pytest.raises(ValueError):
        lake.paths("platinum", "t")


def test_lake_from_session(spark):
    with pytest.raises(ValueError):
        LakeConfig.from_session(spark)
    spark.conf.set("spark.alluvia.root", "/lake")
    spark.conf.set("spark.alluvia.gold.database", "marts")
    try:
        assert LakeConfig.from_session(spark).paths("gold", "t").name == "marts.t"
    finally:
        spark.conf.unset("spark.alluvia.root")
        spark.conf.unset("spark.alluvia.gold.database")


def test_topic_options():
    assert topic_options("t", {"kafka.bootstrap.servers": "b:1"}) == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false",
    }
    given = {"startingOffsets": "latest", "kafka.sasl.mechanism": "PLAIN", "maxOffsetsPerTrigger": "9"}
    assert given.items() <= topic_options("t", given).items()


def test_ids_above_32_bits(spark):
    ticks = spark.sql("SELECT CAST(4294967296 AS BIGINT) AS value, TIMESTAMP '2024-01-01' AS timestamp")
    assert events_from_rate(ticks).first().id == 2**32


def test_profiles_set_no_broadcast_hints_and_keep_aqe():
    for name in PROFILES:
        settings = profile_settings(name)
        assert settings["spark.sql.adaptive.enabled"] == "true"
        initial = int(settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"])
        assert initial > int(settings["spark.sql.shuffle.partitions"])


def test_shared_folder_comes_from_the_session(spark):
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


ENVELOPE = "key string, value string, timestamp timestamp"


def test_decode_edge_cases(spark):
    at = datetime(2024, 1, 1)
    bodies = [
        '{"match_id":"m","gameId":3000000000,"game_length":1.5,"unknown":{"x":1}}', "{bad", '{"gameId":"7"}',
        '{"gameId":null}', "{}", None, '{"gameId":1,"tft_set_number":99999999999}',
    ]
    df = decode_messages(spark.createDataFrame([(str(i), b, at) for i, b in enumerate(bodies)], ENVELOPE), MATCH)
    assert df.columns == ["message_key", "kafka_timestamp", *MATCH.names]
    rows = {r.message_key: r for r in df.collect()}
    assert len(rows) == len(bodies)
    assert (rows["0"].gameId, rows["0"].match_id, rows["0"].game_length) == (3000000000, "m", 1.5)
    assert all(rows[k].gameId is None for k in "12345")
    assert rows["6"].tft_set_number is None
    assert "kafka_timestamp" not in decode_messages(
        spark.createDataFrame([("k", "{}", at)], ENVELOPE), MATCH, arrival=False
    ).columns


def test_message_keys(spark):
    df = spark.createDataFrame([("m1", 5, "p"), ("m2", None, None)], "match_id string, gameId long, puuid string")
    assert [r[0] for r in df.select(match_key()).collect()] == ["5", "m2"]
    assert [r[0] for r in df.select(participant_key()).collect()] == ["5_p", "None_None"]
    at = F.lit(datetime(2024, 3, 4, 5, 6, 7))
    assert df.limit(1).select(summoner_key(F.lit("GOLD"), F.lit("II"), at)).first()[0] == "p_GOLD_II_20240304_050607"
    message = to_messages(df, match_key()).filter("key = 'm2'").first()
    assert '"gameId":null' in message.value


def test_csv_by_name_and_whole_numbers(spark, here):
    with open(f"{here}/traits.csv", "w") as out:
        out.write("trait_id,set,trait_name,trait_desc,icon," + ",".join(TRAITS_CSV.names[5:]) + "\n")
        out.write('T1,3.0,"a, ""quoted""",<b>,,' + ",".join(["2.0"] * 14 + ["2.5"]) + "\n")
    row = read_csv_strict(spark, f"{here}/traits.csv", TRAITS_CSV).first()
    assert (row.set, row.trait_id, row.trait_name, row.icon, row.tier1_min, row.tier5_style) == (
        3, "T1", 'a, "quoted"', None, 2, None,
    )
    with pytest.raises(ValueError, match="item_id"):
        read_csv_strict(spark, f"{here}/traits.csv", ITEMS_CSV)


def test_csv_round_trip_sorted(spark, here):
    schema = record((INT, "n"), (STRING, "t"))
    rows = [(i % 7, f'x,"{i}"') for i in range(50)]
    write_csv(spark.createDataFrame(rows, schema), f"{here}/c", ["n"])
    back = read_csv_strict(spark, f"{here}/c", schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_lines(spark, here):
    with open(f"{here}/l.txt", "w") as out:
        out.write("  a \n\n# no\n\t#no\nb\r\na\n   \nc # kept\n")
    assert sorted(r.value for r in read_lines(spark, f"{here}/l.txt").collect()) == ["a", "a", "b", "c # kept"]
    assert sorted(r.value for r in read_lines(spark, f"{here}/l.txt", unique=True).collect()) == ["a", "b", "c # kept"]
    assert read_lines(spark, f"{here}/l.txt", comment=None).count() == 6


def test_documents(spark, here):
    with open(f"{here}/d.json", "w") as out:
        out.write('{\n "a": 1,\n "b": "x"\n}')
    assert read_documents(spark, f"{here}/d.json", record((INT, "a"), (STRING, "b"))).first().b == "x"


def test_rate_events(spark):
    ticks = spark.createDataFrame([(i, datetime(2024, 1, 1)) for i in range(6)], "value long, timestamp timestamp")
    rows = events_from_rate(ticks).collect()
    assert [r.event_type for r in rows] == ["purchase", "view", "click"] * 2
    assert all(0 <= r.amount < 1000 for r in rows) and rows[3].name == "User_3"
    assert read_rate_events(spark).isStreaming


def test_stream_bounds_exclude_each_other(spark, here):
    with pytest.raises(ValueError):
        stream_table(spark, here, ticks_schema(), max_files=1, max_bytes=1)


def test_message_files_are_packed_and_bounded(spark, here, monkeypatch):
    """Plain lines are many times the values in them, and a packed file goes to one reader. Plain files from before are read as well."""
    monkeypatch.setattr(message_files, "FILE_MESSAGES", 500, raising=False)
    games = spark.range(4000, numPartitions=2).select(
        F.concat(F.lit("VN2_"), F.col("id").cast("string")).alias("match_id"), F.col("id").alias("gameId"), F.sha1(F.col("id").cast("string")).alias("tft_game_type"))
    odd = spark.createDataFrame([("a\nb", "{}"), ("k", None), (None, '{"gameId": "\u00e9\U0001f3b2\\n"}')], "key string, value string")
    at = F.lit(datetime(2024, 2, 1, 3, 4, 5)).alias("timestamp")
    sent = to_messages(games, match_key()).unionByName(odd).withColumn("timestamp", at)
    message_files.write_message_files(sent, f"{here}/in")
    sizes = [os.path.getsize(name) for name in glob(f"{here}/in/part-*")]
    sent.write.json(f"{here}/plain")
    assert sum(sizes) < sum(os.path.getsize(name) for name in glob(f"{here}/plain/part-*")) / 2
    assert max(r["count"] for r in spark.read.text(f"{here}/in").groupBy(F.input_file_name()).count().collect()) <= 500

    games.limit(10).select(F.lit("old").alias("key"), F.lit("{}").alias("value"), at).write.mode("append").json(f"{here}/in")
    append_stream(stream_messages(spark, f"{here}/in"), f"{here}/out", f"{here}/checkpoint", None).awaitTermination()
    got = spark.read.parquet(f"{here}/out")
    assert got.filter("key = 'old'").count() == 10 and got.count() == 4013
    new = got.filter("key IS DISTINCT FROM 'old'")
    assert new.exceptAll(sent).isEmpty() and sent.exceptAll(new).isEmpty()


def ticks_schema():
    return record((INT, "a"))
