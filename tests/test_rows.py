import random

from pyspark.sql import functions as F

from alluvia.functions import row_hash
from alluvia.operators import changes, nested, profile, reports, rows, static_data
from alluvia.operators.league import summoner_rows
from alluvia.plans import ingest
from alluvia.queries import lake, registry
from alluvia.queries import static as static_queries
from alluvia.queries.nested import match_documents
from alluvia.schemas import MATCH_DOCUMENT, STATIC_DATA
from alluvia.sinks.messages import write_csv
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_required_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, r string")
    assert rows.required_keys(df, ["k", "r"]).count() == 1


def test_latest_is_deterministic_and_brute_force_equal(spark):
    dice = random.Random(3)
    data = [(dice.randrange(20), dice.randrange(5), dice.choice([None, 1.0, 2.0]), i) for i in range(500)]
    df = spark.createDataFrame(data, "k int, t int, v double, i int")
    best = {}
    for k, t, v, i in data:
        rank = (t, (v is not None, v or 0.0), i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v, i))
    wanted = sorted(r for _, r in best.values())
    for parts in (1, 7):
        got = rows.latest_per_key(df.repartition(parts), ["k"], ["t"])
        assert sorted(map(tuple, got.collect())) == wanted


def test_dedup_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(rows.dedup_batch(df, ["k"], ["v"]))
    below_exchange = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_dedup_across_batches(spark):
    stored = spark.createDataFrame([(1, 0)] * 50, "k int, v int")
    batch = spark.createDataFrame([(1, 1), (2, 2), (2, 3)], "k int, v int")
    assert [tuple(r) for r in rows.dedup_batch(batch, ["k"], ["v"], stored).collect()] == [(2, 3)]
    assert rows.dedup_batch(batch, ["k"], ["v"]).count() == 2


def test_unseen_reduces_the_seen_side_first(spark):
    text = plan(rows.unseen_ids(spark.range(10), spark.range(1000).selectExpr("id % 3 AS id"), ["id"]))
    assert text.count("HashAggregate") >= 4  # distinct on both sides, partial and final


def test_routing_is_complete(spark):
    df = spark.createDataFrame([("Augment",), ("x",), (None,)], "t string")
    hit, miss = rows.routed(df, F.col("t").contains("Augment"))
    assert (hit.count(), miss.count()) == (1, 2)


def states(spark):
    ddl = "k int, r string, v string"
    current = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (1, "b", None)], ddl)
    incoming = spark.createDataFrame([(1, "a", "x"), (2, "a", "z"), (1, "b", "n"), (3, "a", "w")], ddl)
    return [df.withColumn("hash_key", row_hash(["v"])) for df in (current, incoming)]


def test_change_detection(spark):
    current, incoming = states(spark)
    keys = ["k", "r"]
    found = {(r.k, r.r): r.change for r in changes.change_detect(incoming, current, keys).collect()}
    assert found == {(2, "a"): "changed", (1, "b"): "changed", (3, "a"): "new"}
    split = changes.stack(changes.changed_rows(incoming, current, keys), changes.new_rows(incoming, current, keys))
    assert sorted((r.k, r.r) for r in split.collect()) == sorted(found)
    assert changes.current_for_batch(current, incoming.filter("k = 1"), keys).count() == 2


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B", 7), (3, "C", 8)], "k int, v string, extra int")
    got = {tuple(r) for r in changes.upsert_merge(target, source, ["k"]).collect()}
    assert got == {(1, "a", None), (2, "B", 7), (3, "C", 8)}


def test_no_operator_leaves_the_jvm(spark):
    current, incoming = states(spark)
    for df in (changes.change_detect(incoming, current, ["k", "r"]), rows.dedup_batch(incoming, ["k"])):
        assert "Python" not in plan(df)


def test_filters_reach_the_scan(spark):
    from tests.conftest import SMALL

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    text = plan(rows.required_keys(events.select("user_id", "event_type"), ["user_id"]).filter("event_type = 'view'"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text


MATCH_BODIES = [
    '{"metadata":{"match_id":"M1"},"info":{"gameId":1,"participants":[{"puuid":"p1","placement":1,"units":['
    '{"character_id":"c1","tier":2,"itemNames":["a","b","c","d"]},{"character_id":"c2"}]},{"puuid":"p2"}]}}',
    '{"metadata":{},"info":{"gameId":2,"participants":[]}}',
    '{"metadata":{"match_id":"M3"},"info":{"gameId":3}}',
    "{bad",
]


def test_match_documents(spark):
    raw = spark.createDataFrame([(b,) for b in MATCH_BODIES], "body string")
    documents = nested.parse_match_documents(raw)
    assert documents.schema == MATCH_DOCUMENT
    assert sorted((r.match_id or "", r.gameId or 0) for r in nested.match_rows(documents).collect()) == [
        ("", 0), ("", 2), ("M1", 1), ("M3", 3),
    ]
    header = nested.match_rows(nested.parse_match_documents(raw, header_only=True))
    assert header.exceptAll(nested.match_rows(documents)).count() == 0
    assert [(r.puuid, r.placement) for r in nested.participant_rows(documents).collect()] == [("p1", 1), ("p2", None)]
    units = nested.unit_rows(documents).collect()
    assert [tuple(u)[3:] for u in units] == [("c1", 2, "a", "b", "c"), ("c2", None, None, None, None)]


def test_documents_are_parsed_once(spark):
    raw = spark.createDataFrame([(b,) for b in MATCH_BODIES], "body string")
    assert plan(nested.unit_rows(nested.parse_match_documents(raw))).count("from_json(") == 1
    assert plan(static_data.unit_dimension(static_documents(spark))).count("from_json(") == 1


STATIC_BODY = """{"sets": {
  "14": {"champions": [
      {"apiName": "TFT14_Ahri", "name": "Ahri", "cost": 3, "traits": ["a", "b", "c", "d", "e"],
       "stats": {"hp": 700.0, "range": 4}, "ability": {"name": "Orb", "desc": "<b>Deal</b>\\n damage"}},
      {"apiName": "TFT14_GolemBig", "name": "Golem"}, {"name": "NoId"}],
    "traits": [{"apiName": "T", "name": "t", "desc": null, "effects": [{"minUnits": 1, "maxUnits": 2, "style": 1},
      {"minUnits": 3, "maxUnits": 4, "style": 2}, {}, {}, {}, {"minUnits": 9}]}, {"apiName": "U"}]},
  "TFTSet": {"champions": [{"apiName": "skipped"}], "traits": []}},
 "items": [{"apiName": "TFT14_Item_Sword", "name": "Sword", "composition": ["x", "y"], "unique": true},
   {"apiName": "Base", "name": "Base"}, {"apiName": "TFT9_Augment_A", "icon": "a_II.tex"},
   {"apiName": "TFT9_TeamupAugment_B", "icon": "b_i.tex", "associatedTraits": ["p", "q"]},
   {"name": "no id"}]}"""


def static_documents(spark):
    raw = spark.createDataFrame([(STATIC_BODY,)], "body string")
    return raw.select(F.from_json("body", STATIC_DATA).alias("d")).select("d.*")


def test_static_dimensions(spark):
    documents = static_documents(spark)
    units = {r.unit_name: r for r in static_data.unit_dimension(documents).collect()}
    assert set(units) == {"Ahri", "NoId"}
    ahri = units["Ahri"]
    assert (ahri.set, ahri.trait4, ahri.num_traits, ahri.all_traits, ahri.ability_desc, ahri.health, ahri.armor) == (
        14, "d", 5, "a, b, c, d, e", "Deal damage", 700.0, None,
    )
    assert (units["NoId"].unit_id, units["NoId"].trait1, units["NoId"].num_traits) == ("", "", 0)
    traits = {r.trait_id: r for r in static_data.trait_dimension(documents).collect()}
    assert (traits["T"].tier2_max, traits["T"].tier3_min, traits["T"].tier5_min, traits["U"].tier1_min) == (4, None, None, None)
    items = {r.item_name: r for r in static_data.item_dimension(documents).collect()}
    assert set(items) == {"Sword", "Base", "no id"}
    assert (items["Sword"].set, items["Sword"].component2, items["Sword"].unique) == (14, "y", True)
    assert (items["Base"].set, items["Base"].num_components, items["Base"].unique) == (None, 0, False)
    augments = {r.augment_id: (r.set, r.tier, r.associated_traits) for r in static_data.augment_dimension(documents).collect()}
    assert augments == {"TFT9_Augment_A": (9, "Gold", ""), "TFT9_TeamupAugment_B": (9, "Silver", "p, q")}


def test_league_shapes(spark):
    answers = [
        ("CHALLENGER", None, '{"tier":"CHALLENGER","entries":[{"puuid":"a","rank":"III","wins":2}]}'),
        ("master", "", '{"entries":[{"puuid":"b"}]}'), ("challenger", "I", '[{"puuid":"wrong"}]'),
        ("iron", "IV", ' [{"puuid":"c","tier":"X","leaguePoints":5},{}]'), ("gold", "I", '{"puuid":"wrong"}'),
        ("gold", "I", None), ("gold", "I", "[bad"),
    ]
    df = summoner_rows(spark.createDataFrame(answers, "tier string, division string, body string"))
    got = sorted((r.puuid, r.region, r.tier, r.rank, r.leaguePoints, r.wins, r.losses) for r in df.collect())
    assert got == [
        ("", "VN2", "IRON", "IV", 0, 0, 0), ("a", "VN2", "CHALLENGER", "III", 0, 2, 0),
        ("b", "VN2", "MASTER", "I", 0, 0, 0), ("c", "VN2", "X", "IV", 5, 0, 0),
    ]


def test_summoner_messages_carry_the_request_in_their_key(spark):
    from alluvia.plans.ingest import summoner_messages
    from alluvia.schemas import SUMMONER

    answers = [("gold", "II", '[{"puuid":"a","tier":"SILVER","rank":"IV"}]'), ("master", None, '{"entries":[{"puuid":"b"}]}')]
    made = summoner_messages(spark.createDataFrame(answers, "tier string, division string, body string"))
    assert made.columns == ["key", "value", "timestamp"]
    keys = sorted(r.key for r in made.collect())
    assert keys[0].startswith("a_gold_II_2") and keys[1].startswith("b_master_None_2")
    payload = made.select(F.from_json("value", SUMMONER).alias("p")).select("p.*")
    assert {(r.puuid, r.tier, r.rank) for r in payload.collect()} == {("a", "SILVER", "IV"), ("b", "MASTER", "I")}
    assert payload.filter("ingest_ts IS NULL").count() == 0


def test_json_profile(spark):
    bodies = ['{"a":{"x":1,"y":2},"b":[{"p":1}],"c":"{text"}', '{"a":{"x":1},"b":[],"c":5}', "{bad", None]
    found = profile.json_key_profile(spark.createDataFrame([(b,) for b in bodies], "body string"))
    got = {(r.key, r.kind, r.sample): (r.documents, r.min_size, r.max_size) for r in found.collect()}
    assert got == {
        ("a", "dict", "x"): (2, 1, 2), ("b", "list", "p"): (2, 0, 1), ("c", "scalar", "bigint"): (2, None, None),
    }


def test_reports(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 4.0)], "k string, v double")
    assert [tuple(r) for r in reports.value_counts(df, "k").collect()] == [("a", 2), ("b", 1)]
    assert [r[0] for r in reports.distinct_sorted(df, "k").collect()] == ["a", "b"]
    assert tuple(reports.value_range(df, "v", "v").first()) == (7.0 / 3, 1.0, 4.0)
    assert "TakeOrderedAndProject" in plan(reports.top_rows(df, ["v"], 2))


def test_sorting_spreads_exact_copies(spark):
    copies = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    from tests.conf import settings

    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        sizes = reports.sorted_rows(copies, ["a"]).groupBy(F.spark_partition_id()).count().collect()
        assert max(s["count"] for s in sizes) < 20_000
    mixed = spark.createDataFrame([(3, "c"), (1, "b"), (1, "a"), (2, "z")], "n int, t string")
    assert [tuple(r) for r in reports.sorted_rows(mixed, ["n"]).collect()] == [(1, "a"), (1, "b"), (2, "z"), (3, "c")]


def test_documents_are_made_by_many_tasks(spark):
    """A narrow table is one split of a scan; its documents are not the work of one task."""
    made = static_queries.static_documents(spark, SMALL)
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert made.count() == spark.read.parquet(f"{SMALL}/part.parquet").count()


def test_spread_follows_the_size(spark, tmp_path):
    spark.range(3000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).write.parquet(f"{tmp_path}/t.parquet")
    assert registry.spread(spark, str(tmp_path), "t", "id", task_bytes=1024).rdd.getNumPartitions() > 100


def test_sorted_csv_makes_its_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: made.add(1) or x, "long").asNondeterministic()
    write_csv(spark.range(500).select(seen("id").alias("id")), f"{tmp_path}/out.csv", ["id"])
    assert made.value == 500
    assert spark.read.option("header", "true").csv(f"{tmp_path}/out.csv").count() == 500


def test_match_documents_are_made_by_many_tasks(spark):
    orders = lake.order_rows(spark, SMALL)
    assert orders.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert orders.exceptAll(spark.read.parquet(f"{SMALL}/orders.parquet")).isEmpty()
    messages = lake.match_messages(orders)
    assert plan(messages).count("from_json(") == 1
    whole = ingest.match_messages(nested.parse_match_documents(match_documents(orders)))["match"]
    assert messages.select("key", "value").exceptAll(whole.select("key", "value")).isEmpty() and messages.count() == whole.count()
