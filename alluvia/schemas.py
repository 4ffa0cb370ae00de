"""Payload, document and file schemas. Names and types are fixed values; ids are BIGINT throughout."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOLEAN, TIMESTAMP = T.BooleanType(), T.TimestampType()


def record(*groups: tuple[T.DataType, str]) -> T.StructType:
    """A struct from (type, "name name ...") groups, in the given order."""
    return T.StructType([T.StructField(name, kind) for kind, names in groups for name in names.split()])


def many(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


ENVELOPE = record((STRING, "key value"), (TIMESTAMP, "timestamp"))
MESSAGE_HEAD = record((STRING, "message_key"), (TIMESTAMP, "kafka_timestamp"))
AUDIT = record((TIMESTAMP, "processed_ts"), (INT, "year month day"))

MATCH = record(
    (STRING, "match_id"), (LONG, "gameId"), (DOUBLE, "game_datetime game_length"),
    (STRING, "game_version tft_game_type tft_set_core_name"), (INT, "tft_set_number"),
)
PARTICIPANT_FACTS = "placement gold_left last_round level players_eliminated total_damage_to_players"
PARTICIPANT = record((STRING, "match_id"), (LONG, "gameId"), (STRING, "puuid"), (INT, PARTICIPANT_FACTS))
UNIT_USE = record(
    (STRING, "match_id"), (LONG, "gameId"), (STRING, "puuid character_id"), (INT, "tier"), (STRING, "item1 item2 item3")
)
LEAGUE_ENTRY = record((STRING, "puuid tier rank"), (INT, "leaguePoints wins losses"))
SUMMONER = record(
    (STRING, "puuid region tier rank"), (INT, "leaguePoints wins losses"), (TIMESTAMP, "ingest_ts")
)

UNIT_DOCUMENT = record((STRING, "character_id"), (INT, "tier"), (many(STRING), "itemNames"))
PARTICIPANT_DOCUMENT = record((STRING, "puuid"), (INT, PARTICIPANT_FACTS), (many(UNIT_DOCUMENT), "units"))
MATCH_HEADER_DOCUMENT = record((record((STRING, "match_id")), "metadata"), (T.StructType(MATCH.fields[1:]), "info"))
MATCH_DOCUMENT = record(
    (record((STRING, "match_id")), "metadata"),
    (T.StructType([*MATCH.fields[1:], T.StructField("participants", many(PARTICIPANT_DOCUMENT))]), "info"),
)

LEAGUE_PAGE = record((STRING, "tier"), (many(LEAGUE_ENTRY), "entries"))

CHAMPION_DOCUMENT = record(
    (STRING, "apiName name"), (INT, "cost"), (many(STRING), "traits"),
    (record((DOUBLE, "hp armor magicResist damage attackSpeed range initialMana mana critChance critMultiplier")), "stats"),
    (record((STRING, "name desc")), "ability"),
)
TRAIT_DOCUMENT = record(
    (STRING, "apiName name desc icon"), (many(record((INT, "minUnits maxUnits style"))), "effects")
)
ITEM_DOCUMENT = record(
    (STRING, "apiName name desc icon"), (many(STRING), "composition"), (BOOLEAN, "unique"),
    (many(STRING), "associatedTraits"),
)
STATIC_DATA = record(
    (T.MapType(STRING, record((many(CHAMPION_DOCUMENT), "champions"), (many(TRAIT_DOCUMENT), "traits"))), "sets"),
    (many(ITEM_DOCUMENT), "items"),
)

UNITS_CSV = record(
    (INT, "set"), (STRING, "unit_id unit_name"), (INT, "cost"), (STRING, "trait1 trait2 trait3 trait4"),
    (INT, "num_traits"), (STRING, "all_traits ability_name ability_desc"),
    (DOUBLE, "health armor magic_resist attack_damage attack_speed attack_range mana_start mana_max crit_chance"
             " crit_multiplier"),
)
ITEMS_CSV = record(
    (INT, "set"), (STRING, "item_id item_name item_desc icon component1 component2"), (INT, "num_components"),
    (BOOLEAN, "unique"),
)
TRAIT_TIERS = 5
TRAITS_CSV = record(
    (INT, "set"), (STRING, "trait_id trait_name trait_desc icon"),
    *[(INT, f"tier{n}_min tier{n}_max tier{n}_style") for n in range(1, TRAIT_TIERS + 1)],
)
AUGMENTS_CSV = record(
    (INT, "set"), (STRING, "augment_id augment_name augment_desc tier icon associated_traits")
)

DEMO_EVENT = record((LONG, "id"), (STRING, "name event_type"), (INT, "amount"), (TIMESTAMP, "ingest_ts"))
