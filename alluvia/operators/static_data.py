"""Static documents (sets with champions and traits, items with augments) to dimension rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.functions.arrays import array_text, element_columns, safe_size, struct_columns, unnest
from alluvia.functions.labels import contains_any, first_label, is_whole_number
from alluvia.functions.text import leading_number, strip_markup
from alluvia.operators.rows import excluding, routed
from alluvia.schemas import TRAIT_TIERS

# Names of non-playable champions, the mark of augments, and the tier rules on icon paths.
NON_PLAYABLE = ["dummy", "golem", "krug", "wolf", "razorbeak", "scuttler", "herald", "dragon", "voidspawn"]
AUGMENT_MARK = "Augment"
TIER_RULES = [
    ("Silver", ["_i.", "silver"]),
    ("Gold", ["_ii.", "gold"]),
    ("Prismatic", ["_iii.", "prismatic"]),
]
SET_PREFIX = "TFT"

UNIT_SORT = ["set", "cost", "unit_name"]
TRAIT_SORT = ["set", "trait_name"]
ITEM_SORT = ["set", "item_name"]
AUGMENT_SORT = ["set", "tier", "augment_name"]


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def set_members(documents: DataFrame, member: str) -> DataFrame:
    """(set, member struct) rows from the numbered entries of the ``sets`` map."""
    sets = unnest(documents, "sets", ("_key", "_set")).filter(is_whole_number(F.col("_key")))
    return unnest(sets, f"_set.{member}", "m", F.col("_key").try_cast("int").alias("set"))


def unit_dimension(documents: DataFrame, non_playable: Sequence[str] = NON_PLAYABLE) -> DataFrame:
    champions = excluding(set_members(documents, "champions"), contains_any(F.col("m.apiName"), non_playable))
    traits = F.col("m.traits")
    stats = {
        "health": "hp", "armor": "armor", "magic_resist": "magicResist", "attack_damage": "damage",
        "attack_speed": "attackSpeed", "attack_range": "range", "mana_start": "initialMana", "mana_max": "mana",
        "crit_chance": "critChance", "crit_multiplier": "critMultiplier",
    }
    return champions.select(
        "set",
        text_or_empty("m.apiName").alias("unit_id"),
        text_or_empty("m.name").alias("unit_name"),
        "m.cost",
        *element_columns(traits, "trait", 4, fill=""),
        safe_size(traits).alias("num_traits"),
        array_text(traits).alias("all_traits"),
        text_or_empty("m.ability.name").alias("ability_name"),
        strip_markup(F.col("m.ability.desc")).alias("ability_desc"),
        *[F.col(f"m.stats.{source}").alias(name) for name, source in stats.items()],
    )


def trait_dimension(documents: DataFrame) -> DataFrame:
    tiers = struct_columns(
        F.col("m.effects"), "tier{n}_{part}", TRAIT_TIERS,
        {"min": "minUnits", "max": "maxUnits", "style": "style"},
    )
    return set_members(documents, "traits").select(
        "set",
        text_or_empty("m.apiName").alias("trait_id"),
        text_or_empty("m.name").alias("trait_name"),
        strip_markup(F.col("m.desc")).alias("trait_desc"),
        text_or_empty("m.icon").alias("icon"),
        *tiers,
    )


def trait_tier_rows(documents: DataFrame) -> DataFrame:
    """(set, trait_id, tier, min, max, style): one row per effect, however many a trait has.

    The wide dimension has columns for the first tiers only; this table has all.
    """
    traits = set_members(documents, "traits").select("set", text_or_empty("m.apiName").alias("trait_id"), "m.effects")
    listed = traits.select("set", "trait_id", F.posexplode("effects").alias("_at", "e")).filter(F.col("e").isNotNull())
    return listed.select(
        "set", "trait_id", (F.col("_at") + 1).alias("tier"), F.col("e.minUnits").alias("min"), F.col("e.maxUnits").alias("max"),
        F.col("e.style").alias("style"),
    )


def items_and_augments(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the item list: augments carry the mark in their id, everything else is an item."""
    listed = unnest(documents, "items", "m")
    augments, items = routed(listed, F.col("m.apiName").contains(AUGMENT_MARK))
    return items, augments


def item_dimension(documents: DataFrame) -> DataFrame:
    items, _ = items_and_augments(documents)
    parts = F.col("m.composition")
    return items.select(
        leading_number(F.col("m.apiName"), SET_PREFIX, "_").alias("set"),
        text_or_empty("m.apiName").alias("item_id"),
        text_or_empty("m.name").alias("item_name"),
        strip_markup(F.col("m.desc")).alias("item_desc"),
        text_or_empty("m.icon").alias("icon"),
        *element_columns(parts, "component", 2, fill=""),
        safe_size(parts).alias("num_components"),
        F.coalesce(F.col("m.unique"), F.lit(False)).alias("unique"),
    )


def augment_dimension(documents: DataFrame) -> DataFrame:
    _, augments = items_and_augments(documents)
    return augments.select(
        leading_number(F.col("m.apiName"), SET_PREFIX, "_").alias("set"),
        text_or_empty("m.apiName").alias("augment_id"),
        text_or_empty("m.name").alias("augment_name"),
        strip_markup(F.col("m.desc")).alias("augment_desc"),
        first_label(F.col("m.icon"), TIER_RULES, "Unknown").alias("tier"),
        text_or_empty("m.icon").alias("icon"),
        array_text(F.col("m.associatedTraits")).alias("associated_traits"),
    )
