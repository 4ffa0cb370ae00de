"""Change detection against a current table, and keyed upserts.

Callers pass sides with one row per key (see ``latest_per_key``), so every join here is 1:1 and a hot
key cannot multiply. Nothing is hinted: a small batch is broadcast by size, a large one sort-merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.operators.rows import key_join

HASH = "hash_key"


def current_for_batch(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], unique: bool = False, nullable: Sequence[str] = ()
) -> DataFrame:
    """Current rows whose full business key occurs in the batch.

    Pass ``unique`` when the batch has one row per key already; otherwise its keys are made distinct, so a
    key with many copies is reduced in the map tasks.
    """
    wanted = batch.select(*keys)
    return key_join(current, wanted if unique else wanted.distinct(), keys, "left_semi", nullable)


def change_detect(
    incoming: DataFrame, current: DataFrame, keys: Sequence[str], kind: str | None = "change",
    nullable: Sequence[str] = (),
) -> DataFrame:
    """Incoming rows that are new or differ from their current row, in one left join.

    ``kind`` names the added column ('new' / 'changed'); None leaves it out.
    """
    stored = current.select(*keys, F.col(HASH).alias("_stored"), F.lit(True).alias("_known"))
    compared = key_join(incoming, stored, keys, "left", nullable).filter(
        F.col("_known").isNull() | (F.col(HASH) != F.col("_stored"))
    )
    columns = [F.col(c) for c in incoming.columns]
    if kind:
        columns.append(F.when(F.col("_known").isNull(), "new").otherwise("changed").alias(kind))
    return compared.select(*columns)


def changed_rows(incoming: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    stored = current.select(*keys, F.col(HASH).alias("_stored"))
    return (
        incoming.join(stored, list(keys))
        .filter(F.col(HASH) != F.col("_stored"))
        .select(*incoming.columns)
    )


def new_rows(incoming: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    return incoming.join(current.select(*keys), list(keys), "left_anti").select(*incoming.columns)


def stack(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; columns missing on one side are NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def upsert_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], nullable: Sequence[str] = ()) -> DataFrame:
    """The target after update-all / insert-all: source rows win, other target rows stay."""
    untouched = key_join(target, source.select(*keys), keys, "left_anti", nullable)
    return stack(untouched, source)
