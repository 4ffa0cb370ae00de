"""A Bloom sketch of keys, built and merged by Spark's bitmap aggregates, and a cheap test against it.

A sketch is a table of blocks of 2^15 bits. A key belongs to one block and sets ``hashes`` bits in it, so a test reads one block. The
sketch of a union is the OR of the sketches, block by block. A key that was put in always tests positive; of others, about 2 % do at ten
bits for each key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.operators.rows import distinct_keys, unseen

BLOCK_BITS = 1 << 15  # fixed value: the size of the bitmaps that Spark's aggregates make


@dataclass(frozen=True)
class Shape:
    """Sketches can be merged and tested only by the shape that they were built with."""

    blocks: int
    hashes: int = 4

    @classmethod
    def for_keys(cls, keys: int, bits_per_key: int = 10, most_bytes: int = 32 << 20) -> Shape:
        """Room for ``keys``, within ``most_bytes``: a sketch is broadcast, so its size is bounded whatever the number of keys. Where the
        bound bites, more keys test positive by chance and go through the exact join."""
        wanted = -(-max(1, keys) * bits_per_key // BLOCK_BITS)
        return cls(max(1, min(wanted, most_bytes * 8 // BLOCK_BITS)))

    def block(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys, F.lit(-1)), F.lit(self.blocks)).cast("long")

    def bits(self, keys: Sequence[str]) -> list[Column]:
        """Positions in the block, from 0."""
        return [F.pmod(F.xxhash64(*keys, F.lit(n)), F.lit(BLOCK_BITS)).cast("int") for n in range(self.hashes)]


def sketch(df: DataFrame, keys: Sequence[str], shape: Shape) -> DataFrame:
    """``block, bits`` of all keys of ``df``, from partial bitmaps of the map tasks: no key is shuffled."""
    marked = df.select(shape.block(keys).alias("block"), F.explode(F.array(*shape.bits(keys))).alias("bit"))
    return marked.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))


def merged(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The sketch of all keys of several sketches of one shape."""
    return reduce(DataFrame.unionByName, others, first).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, position % 8).bitwiseAND(F.lit(1)) == 1


def maybe_in(df: DataFrame, keys: Sequence[str], built: DataFrame, shape: Shape, into: str = "maybe") -> DataFrame:
    """``df`` with a boolean: false where the key certainly isn't in the sketch. The sketch is broadcast, within its shape's bound."""
    asked = df.withColumn("_block", shape.block(keys))
    met = asked.join(F.broadcast(built.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))), "_block", "left")
    every = reduce(lambda a, b: a & b, [_is_set(F.col("_bits"), p) for p in shape.bits(keys)])
    return met.withColumn(into, F.coalesce(every, F.lit(False))).select(*df.columns, into)


def unseen_by_sketch(incoming: DataFrame, seen: DataFrame, keys: Sequence[str], built: DataFrame, shape: Shape) -> DataFrame:
    """Distinct incoming keys that were never seen, as the exact anti join gives them; ``built`` holds at least the keys of ``seen``.

    Keys that the sketch rules out are news and pass as they are. Only the others are joined with the seen keys, which are cut down to
    those that can match by a sketch of the possible repeats: both sides of the shuffle hold possible repeats alone.
    """
    tested = maybe_in(distinct_keys(incoming, keys), keys, built, shape)
    possible = tested.filter("maybe").drop("maybe")
    wanted = maybe_in(seen.select(*keys), keys, sketch(possible, keys, shape), shape).filter("maybe").drop("maybe")
    return tested.filter("NOT maybe").drop("maybe").unionByName(unseen(possible, wanted, keys))
