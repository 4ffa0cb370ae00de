"""Type-2 history: stamping, one-batch application, and the set-based rebuild."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.functions.audit import date_parts, moment
from alluvia.functions.hashing import row_hash, surrogate_key
from alluvia.operators.changes import HASH, change_detect, current_for_batch, stack
from alluvia.operators.neighbours import with_neighbour
from alluvia.operators.rows import key_join, latest_per_key, required_keys


@dataclass(frozen=True)
class HistorySpec:
    """What identifies a row, which attributes open a new version, and what is merely carried along.

    Rows without a value in the ``required`` keys are dropped (default: all keys). In the other keys NULL is
    a value like any other.
    """

    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    carried: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    strict_hash: bool = False
    required: tuple[str, ...] | None = None

    @property
    def needed_keys(self) -> tuple[str, ...]:
        return self.keys if self.required is None else self.required

    @property
    def nullable(self) -> list[str]:
        return [k for k in self.keys if k not in self.needed_keys]

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.tracked]

    @property
    def layout(self) -> list[str]:
        """Stored column order."""
        return [
            *self.columns, "surrogate_key", "is_current", "effective_date", "end_date", HASH,
            *self.carried, "processed_ts", "year", "month", "day",
        ]


MATCHES = HistorySpec(
    keys=("match_id", "gameId"),
    tracked=("game_datetime", "game_length", "game_version", "tft_game_type", "tft_set_core_name", "tft_set_number"),
    order=("kafka_timestamp",),
    required=("gameId",),
)
SUMMONERS = HistorySpec(
    keys=("puuid", "region"),
    tracked=("tier", "rank", "leaguepoints", "wins", "losses"),
    carried=("ingest_ts",),
    order=("kafka_timestamp",),
)


def last_of_batch(batch: DataFrame, spec: HistorySpec, *per: str) -> DataFrame:
    """Rows with their required keys, the last one per key (and per value of the ``per`` columns).

    Columns the history does not store are dropped before anything is sorted or shuffled.
    """
    order = [c for c in spec.order if c in batch.columns]
    needed = dict.fromkeys([*per, *spec.columns, *spec.carried, *order])
    present = required_keys(batch.select(*needed), spec.needed_keys)
    return latest_per_key(present, [*spec.keys, *per], order)


def stamp(batch: DataFrame, spec: HistorySpec, batch_ts: datetime | Column) -> DataFrame:
    """Give each row the bookkeeping columns of a freshly opened version."""
    at = moment(batch_ts)
    opened = batch.withColumns({
        "processed_ts": at,
        "effective_date": at,
        "end_date": F.nullif(at, at),
        "is_current": F.lit(True),
        HASH: row_hash(spec.tracked, strict=spec.strict_hash),
        "surrogate_key": surrogate_key(spec.keys, at),
        **date_parts(at),
    })
    return opened.select(*spec.layout)


def versions_to_insert(batch: DataFrame, current: DataFrame, spec: HistorySpec, batch_ts: datetime | Column) -> DataFrame:
    """Rows of the batch that open a new version: keys without a current row, or with another hash."""
    incoming = stamp(last_of_batch(batch, spec), spec, batch_ts)
    stored = current_for_batch(current.filter("is_current"), incoming, spec.keys, True, spec.nullable)
    return change_detect(incoming, stored, spec.keys, None, spec.nullable)


def close_versions(
    history: DataFrame, inserted: DataFrame, keys: Sequence[str], nullable: Sequence[str] = ()
) -> DataFrame:
    """The history with the current row of every inserted key closed at that key's new effective date."""
    fresh = inserted.select(*keys, F.col("effective_date").alias("_closed_at"))
    closing = F.col("is_current") & F.col("_closed_at").isNotNull()
    return (
        key_join(history, fresh, keys, "left", nullable)
        .withColumns({
            "end_date": F.when(closing, F.col("_closed_at")).otherwise(F.col("end_date")),
            "is_current": F.col("is_current") & ~closing,
        })
        .select(*history.columns)
    )


def apply_batch(history: DataFrame, batch: DataFrame, spec: HistorySpec, batch_ts: datetime | Column) -> DataFrame:
    """The history after one batch: close, then insert."""
    inserted = versions_to_insert(batch, history, spec, batch_ts)
    return stack(close_versions(history, inserted, spec.keys, spec.nullable), inserted)


def rebuild_history(
    log: DataFrame,
    spec: HistorySpec,
    effective: str,
    segment: Column | None = None,
) -> DataFrame:
    """The whole history from a change log in one set-based pass; equals applying its batches in order.

    ``effective`` is the batch time column. Rows are first reduced to the last one per (key, batch) with a
    map-side group limit, so the window over a key sees at most one narrow row per batch. For a log with a
    very large number of batches pass ``segment``, a coarser non-decreasing function of ``effective``
    (for example its month): then not even those rows of one key meet in one task.
    """
    keys = list(spec.keys)
    hashed = last_of_batch(log, spec, effective).withColumn(HASH, row_hash(spec.tracked, strict=spec.strict_hash))
    compared = with_neighbour(hashed, keys, [effective], HASH, "_before", segment=segment)
    opened = compared.filter(F.col("_before").isNull() | (F.col(HASH) != F.col("_before")))
    closed = with_neighbour(opened, keys, [effective], effective, "end_date", previous=False, segment=segment)
    at = F.col(effective)
    return closed.withColumns({
        "processed_ts": at,
        "effective_date": at,
        "is_current": F.col("end_date").isNull(),
        "surrogate_key": surrogate_key(keys, at),
        **date_parts(at),
    }).select(*spec.layout)
