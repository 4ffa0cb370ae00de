"""Previous / next row of a key, without ever putting a whole key into one task.

A plain ``lag`` over a key sorts all rows of that key in one task. With a ``segment`` that happens per
(key, segment); only the edge row of each segment, which carries the value its neighbouring segment asks
for, goes through a window over the key. A key's largest group is then one segment, or one row per segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    into: str,
    previous: bool = True,
    segment: Column | None = None,
) -> DataFrame:
    """Add ``into``: the value of ``column`` in the previous (or next) row of the key, NULL at the end.

    ``order`` must be total within a key, and ``segment`` must not decrease along it.
    """
    step = F.lag if previous else F.lead
    if segment is None:
        return df.withColumn(into, step(column).over(Window.partitionBy(*keys).orderBy(*order)))

    inside = Window.partitionBy(*keys, "_segment").orderBy(*order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offered = F.last_value if previous else F.first_value
    local = df.withColumn("_segment", segment).withColumns({
        into: step(column).over(inside),
        "_edge": step(F.lit(True)).over(inside).isNull(),
        "_offer": offered(F.col(column)).over(whole),
    })
    # Both branches read the same shuffle. Each segment has one edge row per key.
    inner = local.filter(~F.col("_edge"))
    edges = local.filter("_edge").withColumn(into, step("_offer").over(Window.partitionBy(*keys).orderBy("_segment")))
    return inner.unionByName(edges).select(*df.columns, into)
