"""The tables of the lake and how each is filled. Names, keys and columns are fixed values."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia import schemas
from alluvia.operators import rows, scd2, static_data


@dataclass(frozen=True)
class MessageTable:
    """A bronze table fed by one topic."""

    table: str
    topic: str
    schema: T.StructType
    cluster_by: tuple[str, ...]

    @property
    def stored(self) -> T.StructType:
        """The table's columns: envelope, payload, audit."""
        return T.StructType([*schemas.MESSAGE_HEAD.fields, *self.schema.fields, *schemas.AUDIT.fields])

    def with_fields(self, *more: T.StructField) -> MessageTable:
        """The same table once its messages have more payload fields."""
        return replace(self, schema=T.StructType([*self.schema.fields, *more]))


MESSAGE_TABLES = {
    "match": MessageTable("tft_matches", "tft_match", schemas.MATCH, ("match_id", "gameId")),
    "participant": MessageTable(
        "tft_match_participants", "tft_match_participant", schemas.PARTICIPANT, ("match_id", "gameId", "puuid")
    ),
    "unit": MessageTable(
        "tft_participant_units", "tft_participant_unit", schemas.UNIT_USE, ("match_id", "gameId", "puuid")
    ),
    "summoner": MessageTable("tft_summoners", "tft_summoner", schemas.SUMMONER, ("puuid", "region")),
}


@dataclass(frozen=True)
class HistoryPlan:
    """A silver type-2 table over a bronze table."""

    source: str
    table: str
    spec: scd2.HistorySpec
    rename: tuple[tuple[str, str], ...] = ()

    def project(self, bronze: DataFrame) -> DataFrame:
        """Needed columns under their silver names; rows without their required keys are dropped."""
        names = dict(self.rename)
        wanted = [*self.spec.columns, *self.spec.carried, *self.spec.order]
        selected = bronze.select(*[F.col(names.get(c, c)).alias(c) for c in wanted])
        return rows.required_keys(selected, self.spec.needed_keys)


HISTORIES = {
    "match": HistoryPlan("match", "tft_matches_scd2", scd2.MATCHES),
    "summoner": HistoryPlan(
        "summoner", "tft_summoners_scd2", scd2.SUMMONERS, rename=(("leaguepoints", "leaguePoints"),)
    ),
}


@dataclass(frozen=True)
class AppendPlan:
    """A silver append table over a bronze table, deduplicated within each micro-batch."""

    source: str
    table: str
    keys: tuple[str, ...]
    required: tuple[str, ...]
    columns: tuple[str, ...]


APPENDS = {
    "participant": AppendPlan(
        "participant", "tft_match_participants", tuple(rows.PARTICIPANT_KEYS), ("gameId", "puuid"),
        tuple(schemas.PARTICIPANT.names),
    ),
    "unit": AppendPlan(
        "unit", "tft_participant_units", tuple(rows.UNIT_KEYS), ("gameId", "puuid", "character_id"),
        tuple(schemas.UNIT_USE.names),
    ),
}


@dataclass(frozen=True)
class Dimension:
    """A bronze dimension: how it comes out of the static document, its CSV form and sort order."""

    table: str
    schema: T.StructType
    extract: Callable[[DataFrame], DataFrame]
    order: tuple[str, ...]


DIMENSIONS = {
    "units": Dimension("tft_units", schemas.UNITS_CSV, static_data.unit_dimension, tuple(static_data.UNIT_SORT)),
    "items": Dimension("tft_items", schemas.ITEMS_CSV, static_data.item_dimension, tuple(static_data.ITEM_SORT)),
    "traits": Dimension("tft_traits", schemas.TRAITS_CSV, static_data.trait_dimension, tuple(static_data.TRAIT_SORT)),
    "augments": Dimension(
        "tft_augments", schemas.AUGMENTS_CSV, static_data.augment_dimension, tuple(static_data.AUGMENT_SORT)
    ),
}
