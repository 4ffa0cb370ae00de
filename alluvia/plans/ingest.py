"""Documents and responses to keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.operators import envelope, league, nested
from alluvia.schemas import SUMMONER


def header_messages(documents: DataFrame) -> DataFrame:
    """The messages on matches alone; documents that were parsed without their participants do."""
    return envelope.to_messages(nested.match_rows(documents), envelope.match_key(), F.current_timestamp())


def match_messages(documents: DataFrame) -> dict[str, DataFrame]:
    """The three message sets of parsed match documents, by message table."""
    now = F.current_timestamp()
    return {
        "match": header_messages(documents),
        "participant": envelope.to_messages(nested.participant_rows(documents), envelope.participant_key(), now),
        "unit": envelope.to_messages(nested.unit_rows(documents), envelope.unit_key(), now),
    }


def summoner_messages(responses: DataFrame) -> DataFrame:
    """One message per league entry, keyed by player, requested tier and division, and time."""
    rows = league.summoner_rows(responses, with_request=True)
    key = envelope.summoner_key(F.col("asked_tier"), F.col("asked_division"), F.col("ingest_ts"))
    return envelope.to_messages(rows, key, F.col("ingest_ts"), fields=SUMMONER.names)
