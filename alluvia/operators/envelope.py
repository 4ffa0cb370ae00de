"""Message envelopes: decode JSON payloads, and build keyed JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_messages(
    messages: DataFrame,
    schema: T.StructType,
    key_name: str = "message_key",
    arrival: bool = True,
) -> DataFrame:
    """Flatten JSON message values into columns.

    Malformed payloads and wrongly typed fields become NULL fields, unknown fields are dropped. The
    row itself always stays; required-key filters come later.
    """
    payload = F.from_json(F.col("value").cast("string"), schema)
    head = [F.col("key").cast("string").alias(key_name)]
    if arrival:
        head.append(F.col("timestamp").alias("kafka_timestamp"))
    return messages.select(*head, payload.alias("_payload")).select(
        key_name, *(["kafka_timestamp"] if arrival else []), "_payload.*"
    )


def message_key(parts: Sequence[Column], null_text: str = "None") -> Column:
    """Key parts joined by ``_``; an absent part shows as ``null_text`` and never shifts the others."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit(null_text)) for p in parts])


def to_messages(
    rows: DataFrame, key: Column, timestamp: Column | None = None, fields: Sequence[str] | None = None
) -> DataFrame:
    """(key, value[, timestamp]) rows ready for a message sink; NULL fields stay in the JSON text.

    ``fields`` names the columns of the payload, by default all.
    """
    value = F.to_json(F.struct(*(fields or rows.columns)), {"ignoreNullFields": "false"})
    columns = [key.alias("key"), value.alias("value")]
    if timestamp is not None:
        columns.append(timestamp.alias("timestamp"))
    return rows.select(*columns)


def match_key() -> Column:
    return F.coalesce(F.col("gameId").cast("string"), F.col("match_id"))


def participant_key() -> Column:
    return message_key([F.col("gameId"), F.col("puuid")])


def unit_key() -> Column:
    return message_key([F.col("gameId"), F.col("puuid"), F.col("character_id")])


def summoner_key(tier: Column, division: Column, at: Column) -> Column:
    """``puuid_tier_division_yyyyMMdd_HHmmss`` with the requested tier and division."""
    return message_key([F.col("puuid"), tier, division, F.date_format(at, "yyyyMMdd_HHmmss")])
