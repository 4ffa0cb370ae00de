"""Row filters, deduplication and key sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MATCH_KEYS = ["match_id", "gameId"]
PARTICIPANT_KEYS = ["match_id", "gameId", "puuid"]
UNIT_KEYS = ["match_id", "gameId", "puuid", "character_id"]
SUMMONER_KEYS = ["puuid", "region"]


def key_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, nullable: Sequence[str] = ()
) -> DataFrame:
    """Equi-join on the keys, keeping the left side's key columns. ``nullable`` keys also match NULL with NULL."""
    if not nullable:
        return left.join(right, list(keys), how)
    other = {k: f"_other_{k}" for k in keys}
    conditions = [
        F.col(k).eqNullSafe(F.col(other[k])) if k in nullable else F.col(k) == F.col(other[k]) for k in keys
    ]
    return left.join(right.withColumnsRenamed(other), conditions, how).drop(*other.values())


def required_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], tie_break: bool = True) -> DataFrame:
    """One whole row per key: the last by ``order``, ties settled by all other columns.

    Spark turns ``row_number() <= 1`` into a per-task group limit *before* the shuffle, so each task
    sends at most one row per key and a hot key costs the reducer one row per task, not its whole group.
    """
    ranked = [F.col(c).desc_nulls_last() for c in order]
    if tie_break:
        taken = {*keys, *order}
        ranked += [F.col(c).desc_nulls_last() for c in df.columns if c not in taken]
    pick = Window.partitionBy(*keys).orderBy(*(ranked or [F.lit(0)]))
    return df.withColumn("_pick", F.row_number().over(pick)).filter("_pick = 1").drop("_pick")


def dedup_batch(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    stored: DataFrame | None = None,
) -> DataFrame:
    """Keep one row per key within the batch; with ``stored``, also drop keys already in that table."""
    kept = latest_per_key(df, keys, [c for c in order if c in df.columns])
    return kept if stored is None else unseen(kept, stored, keys)


def unseen(df: DataFrame, seen: DataFrame, keys: Sequence[str], nullable: Sequence[str] = ()) -> DataFrame:
    """Rows whose key is not in ``seen``. The seen side is made distinct first, so that a key with
    many copies there is reduced in the map tasks instead of landing in one join task."""
    return key_join(df, distinct_keys(seen, keys), keys, "left_anti", nullable)


def unseen_ids(incoming: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct incoming ids that were never seen. Record them as seen only after they were processed."""
    return unseen(distinct_keys(incoming, keys), seen, keys)


def excluding(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition is not true; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def routed(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the condition holds, all other rows): every input row is in exactly one output."""
    return df.filter(condition), excluding(df, condition)
