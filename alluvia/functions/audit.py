from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(batch_ts: datetime | Column | None) -> Column:
    """The batch's one timestamp. Without a value: Spark's, which is constant within a query or micro-batch."""
    if batch_ts is None:
        return F.current_timestamp()
    return batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts)


def date_parts(at: Column) -> dict[str, Column]:
    return {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)}


def with_audit(
    df: DataFrame,
    batch_ts: datetime | Column | None = None,
    column: str = "processed_ts",
    partitions: bool = True,
) -> DataFrame:
    """Stamp the processing time and, by default, its year / month / day."""
    at = moment(batch_ts)
    return df.withColumns({column: at, **(date_parts(at) if partitions else {})})
