"""Nested match documents to flat rows. Parent keys travel with every level; nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.functions.arrays import element_columns, unnest
from alluvia.schemas import MATCH, MATCH_DOCUMENT, MATCH_HEADER_DOCUMENT

PARENT = ["match_id", "gameId"]


def parse_match_documents(raw: DataFrame, column: str = "body", header_only: bool = False) -> DataFrame:
    """JSON text to ``metadata`` / ``info`` structs; ``header_only`` skips over the participants."""
    schema = MATCH_HEADER_DOCUMENT if header_only else MATCH_DOCUMENT
    return raw.select(F.from_json(F.col(column), schema).alias("_doc")).select("_doc.*")


def match_rows(documents: DataFrame) -> DataFrame:
    """One header row per document; missing paths are NULL."""
    return documents.select("metadata.match_id", *[f"info.{name}" for name in MATCH.names[1:]])


def _participants(documents: DataFrame) -> DataFrame:
    return unnest(documents, "info.participants", "_p", "metadata.match_id", "info.gameId")


def participant_rows(documents: DataFrame) -> DataFrame:
    """One row per participant; documents without participants give no rows."""
    return _participants(documents).select(
        *PARENT, "_p.puuid", "_p.placement", "_p.gold_left", "_p.last_round", "_p.level",
        "_p.players_eliminated", "_p.total_damage_to_players",
    )


def unit_rows(documents: DataFrame) -> DataFrame:
    """One row per unit of each participant, its first three items as columns."""
    units = unnest(_participants(documents), "_p.units", "_u", *PARENT, "_p.puuid")
    items = element_columns(F.col("_u.itemNames"), "item", 3)
    return units.select(*PARENT, "puuid", "_u.character_id", "_u.tier", *items)
