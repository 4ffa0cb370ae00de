"""Static documents, one per part, and their dimensions; CSV round trip."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from alluvia.config import LakeConfig
from alluvia.operators import static_data
from alluvia.plans import dimensions
from alluvia.queries.registry import query, spread, table
from alluvia.schemas import STATIC_DATA
from alluvia.session import shared_folder
from alluvia.sinks.messages import write_csv
from alluvia.sources.files import read_csv_strict

STATS = ["hp", "armor", "magicResist", "damage", "attackSpeed", "range", "initialMana", "mana", "critChance"]


def static_documents(spark, folder):
    """One parsed static document per part. Besides its numbered set each has one that must be skipped."""
    key, size, name = F.col("p_partkey"), F.col("p_size"), F.col("p_name")
    prefix = F.concat(F.lit("TFT"), size.cast("string"), F.lit("_"))
    markup = F.concat(F.lit("<b>"), F.col("p_brand"), F.lit("</b><br>\n gives &  \t more "), F.col("p_type"))
    words = F.array(*[F.lit(f"word{i}") for i in range(1, 7)])

    def champion(api_name, traits):
        return F.struct(
            api_name.alias("apiName"), name.alias("name"), (size % 5 + 1).alias("cost"), traits.alias("traits"),
            F.struct(*[(F.col("p_retailprice") + i).alias(s) for i, s in enumerate(STATS)]).alias("stats"),
            F.struct(F.col("p_brand").alias("name"), markup.alias("desc")).alias("ability"),
        )

    second = F.concat(prefix, F.when(key % 2 == 0, "TrainingDUMMY").otherwise("Gear"), key.cast("string"))
    champions = F.array(
        champion(F.concat(prefix, F.replace(name, F.lit(" "))), F.split(name, " ")),
        champion(second, F.slice(words, 1, key % 7)),
    )
    effect = [
        F.struct(F.lit(i).alias("minUnits"), F.lit(i + 1).alias("maxUnits"), F.lit(i % 3).alias("style"))
        for i in range(1, 7)
    ]
    traits = F.array(F.struct(
        F.concat(prefix, F.lit("Trait"), key.cast("string")).alias("apiName"), F.col("p_type").alias("name"),
        markup.alias("desc"), F.col("p_brand").alias("icon"), F.slice(F.array(*effect), 1, key % 7).alias("effects"),
    ))
    members = F.struct(champions.alias("champions"), traits.alias("traits"))
    icons = F.element_at(F.array(*[F.lit(i) for i in ("A_I.png", "b_II.png", "c_iii.png", "plain.png")]), (key % 4 + 1).cast("int"))

    def item(api_name, **fields):
        defaults = {
            "composition": F.lit(None).cast("array<string>"), "unique": F.lit(None).cast("boolean"),
            "associatedTraits": F.lit(None).cast("array<string>"),
        }
        return F.struct(
            api_name.alias("apiName"), name.alias("name"), markup.alias("desc"), icons.alias("icon"),
            *[fields.get(f, empty).alias(f) for f, empty in defaults.items()],
        )

    items = F.array(
        item(
            F.concat(F.when(key % 3 == 0, F.lit("Base_")).otherwise(prefix), F.lit("Item"), key.cast("string")),
            composition=F.slice(F.array(F.lit("sword"), F.lit("bow")), 1, key % 3),
            unique=F.when(key % 2 == 0, True),
        ),
        item(
            F.concat(prefix, F.lit("Augment"), key.cast("string")),
            associatedTraits=F.slice(words, 1, key % 4),
        ),
    )
    body = F.to_json(F.struct(
        F.create_map(size.cast("string"), members, F.lit("mutators"), members).alias("sets"), items.alias("items")
    ))
    texts = spread(spark, folder, "part", "p_partkey").select(body.alias("body"))
    return texts.select(F.from_json("body", STATIC_DATA).alias("d")).select("d.*")


DESC_SQL = "p_brand || ' gives & more ' || p_type"
WORDS_SQL = "['word1', 'word2', 'word3', 'word4', 'word5', 'word6']"
ICON_SQL = "['A_I.png', 'b_II.png', 'c_iii.png', 'plain.png'][p_partkey % 4 + 1]"
CHAMPIONS_SQL = f"""
    champions AS (
        SELECT *, 'TFT' || p_size || '_' || replace(p_name, ' ', '') AS api, string_split(p_name, ' ') AS traits
        FROM part
        UNION ALL
        SELECT *, 'TFT' || p_size || '_Gear' || p_partkey AS api, {WORDS_SQL}[1:p_partkey % 7] AS traits
        FROM part WHERE p_partkey % 2 <> 0)"""


@query("map_explode", f"""
    WITH {CHAMPIONS_SQL}
    SELECT p_size AS "set", api AS unit_id, p_name AS unit_name, p_size % 5 + 1 AS cost,
           coalesce(traits[1], '') AS trait1, coalesce(traits[2], '') AS trait2, coalesce(traits[3], '') AS trait3,
           coalesce(traits[4], '') AS trait4, CAST(len(traits) AS INTEGER) AS num_traits,
           array_to_string(traits, ', ') AS all_traits, p_brand AS ability_name, {DESC_SQL} AS ability_desc,
           p_retailprice AS health, p_retailprice + 1 AS armor, p_retailprice + 2 AS magic_resist,
           p_retailprice + 3 AS attack_damage, p_retailprice + 4 AS attack_speed, p_retailprice + 5 AS attack_range,
           p_retailprice + 6 AS mana_start, p_retailprice + 7 AS mana_max, p_retailprice + 8 AS crit_chance,
           CAST(NULL AS DOUBLE) AS crit_multiplier
    FROM champions""")
def map_explode(spark, folder):
    return static_data.unit_dimension(static_documents(spark, folder))


@query("struct_array_wide", f"""
    SELECT p_size AS "set", 'TFT' || p_size || '_Trait' || p_partkey AS trait_id, p_type AS trait_name,
           {DESC_SQL} AS trait_desc, p_brand AS icon,
           """ + ", ".join(
    f"CASE WHEN p_partkey % 7 >= {n} THEN {value} END AS tier{n}_{part}"
    for n in range(1, 6) for part, value in (("min", n), ("max", n + 1), ("style", n % 3))
) + " FROM part")
def struct_array_wide(spark, folder):
    return static_data.trait_dimension(static_documents(spark, folder))


@query("trait_tier_rows", """
    SELECT p_size AS "set", 'TFT' || p_size || '_Trait' || p_partkey AS trait_id, CAST(n AS INTEGER) AS tier,
           CAST(n AS INTEGER) AS "min", CAST(n + 1 AS INTEGER) AS "max", CAST(n % 3 AS INTEGER) AS style
    FROM part, unnest(generate_series(1, 6)) AS tiers(n) WHERE p_partkey % 7 >= n""")
def trait_tier_rows(spark, folder):
    return static_data.trait_tier_rows(static_documents(spark, folder))


@query("item_rows", f"""
    SELECT CASE WHEN p_partkey % 3 <> 0 THEN nullif(p_size, 0) END AS "set",
           CASE WHEN p_partkey % 3 = 0 THEN 'Base_' ELSE 'TFT' || p_size || '_' END || 'Item' || p_partkey AS item_id,
           p_name AS item_name, {DESC_SQL} AS item_desc, {ICON_SQL} AS icon,
           CASE WHEN p_partkey % 3 >= 1 THEN 'sword' ELSE '' END AS component1,
           CASE WHEN p_partkey % 3 >= 2 THEN 'bow' ELSE '' END AS component2,
           CAST(p_partkey % 3 AS INTEGER) AS num_components, p_partkey % 2 = 0 AS "unique"
    FROM part""")
def item_rows(spark, folder):
    return static_data.item_dimension(static_documents(spark, folder))


@query("augment_rows", f"""
    SELECT nullif(p_size, 0) AS "set", 'TFT' || p_size || '_Augment' || p_partkey AS augment_id, p_name AS augment_name,
           {DESC_SQL} AS augment_desc, ['Silver', 'Gold', 'Prismatic', 'Unknown'][p_partkey % 4 + 1] AS tier,
           {ICON_SQL} AS icon, array_to_string({WORDS_SQL}[1:p_partkey % 4], ', ') AS associated_traits
    FROM part""")
def augment_rows(spark, folder):
    return static_data.augment_dimension(static_documents(spark, folder))


@query("csv_schema_load", """
    SELECT s_suppkey, s_name || ', "' || s_nationkey || '"' AS s_name, s_nationkey, s_acctbal FROM supplier""")
def csv_schema_load(spark, folder):
    """Written with whole numbers as ``3.0`` and another column order; quotes and commas in the text."""
    wanted = table(spark, folder, "supplier").withColumn(
        "s_name", F.concat("s_name", F.lit(', "'), F.col("s_nationkey").cast("string"), F.lit('"'))
    )
    shuffled = wanted.select("s_acctbal", "s_name", F.col("s_nationkey").cast("double").alias("s_nationkey"), "s_suppkey")
    path = write_csv(shuffled, shared_folder(spark, "csv"), ["s_nationkey", "s_name"])
    return read_csv_strict(spark, path, wanted.schema)


@query("load_dimensions", """
    SELECT 'SUCCESS' AS status, 'items' AS name, count(*) AS "count" FROM part
    UNION ALL SELECT 'FAILED', 'units', NULL""")
def load_dimensions(spark, folder):
    """Dimensions loaded from CSV into the catalog, with what became of each: one of the files is not there."""
    home = shared_folder(spark, "dimensions")
    items = static_data.item_dimension(static_documents(spark, folder))
    write_csv(items, f"{home}/items.csv", static_data.ITEM_SORT)
    config = LakeConfig(f"{home}/lake", databases={"bronze": "alluvia_dimensions"})
    outcome = dimensions.load_dimensions(spark, config, home, ["items", "units"])
    rows = [(told["status"], name, told.get("count")) for name, told in outcome.items()]
    return spark.createDataFrame(rows, "status string, name string, count bigint")


@query("csv_sink_order", """
    SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS out_of_order FROM part""")
def csv_sink_order(spark, folder):
    """A sorted CSV sink read back in the order of its files and lines: no line comes before one that it should follow."""
    path = shared_folder(spark, "csv_order")
    parts = table(spark, folder, "part").select("p_size", "p_name", "p_partkey")
    write_csv(parts.repartition(5), path, ["p_size", "p_name", "p_partkey"])
    lines = spark.read.schema(parts.schema).option("header", "true").option("escape", '"').csv(path)
    # Of each file its first and last key and the breaks inside; files follow one another by name.
    placed = lines.select(F.struct("p_size", "p_name", "p_partkey").alias("key"), F.col("_metadata.file_name").alias("file"),
                          F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    inside = Window.partitionBy("file").orderBy("block", "at")
    breaks = placed.withColumn("before", F.lag("key").over(inside)).groupBy("file").agg(
        F.count("*").alias("rows"), F.count_if(F.col("before") > F.col("key")).alias("wrong"), F.min("key").alias("low"), F.max("key").alias("high"))
    joined = breaks.withColumn("wrong", F.col("wrong") + (F.coalesce(F.lag("high").over(Window.orderBy("file")) > F.col("low"), F.lit(False))).cast("long"))
    return joined.agg(F.sum("rows").alias("rows"), F.sum("wrong").alias("out_of_order"))
