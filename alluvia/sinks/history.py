"""A stored type-2 table, divided by buckets of its keys.

Below its bucket a current row lies in ``closed_on=open``, a closed one under the day on which it was closed. A batch reads the current
rows of the buckets that its keys fall into. Where it opens a version, the bucket's current rows and those closed on the same day are
replaced; rows closed on earlier days are never read or written again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.operators.changes import change_detect, stack
from alluvia.operators.scd2 import HistorySpec, close_versions, last_of_batch, rebuild_history, stamp
from alluvia.sinks.buckets import BUCKET, BucketTable
from alluvia.sinks.folders import matching

CLOSED_ON, OPEN = "closed_on", "open"


def day_of(at: str) -> Column:
    return F.date_format(at, "yyyy-MM-dd")


class HistoryTable(BucketTable):
    levels = (BUCKET, CLOSED_ON)

    def __init__(self, spark: SparkSession, path: str, spec: HistorySpec, buckets: int = 16):
        super().__init__(spark, path, spec.keys, buckets)
        self.spec = spec
        self._columns: T.StructType | None = None

    def reader(self):
        """Files have the same columns unless the history's have changed, so one look at one of them usually does for all reads."""
        if self._columns is None:
            place = self.rows if self._has_rows() else self.pending
            for merge in ("false", "true"):
                kinds = {f.name: f for f in self.spark.read.option("mergeSchema", merge).parquet(place).schema.fields}
                self._columns = T.StructType([kinds[name] for name in self.spec.layout if name in kinds])
                if len(self._columns) == len(self.spec.layout):
                    break
        directories = [T.StructField(BUCKET, T.IntegerType()), T.StructField(CLOSED_ON, T.StringType())]
        columns = self._columns
        if len(columns) < len(self.spec.layout):  # not stored yet, the next change may bring them
            self._columns = None
        return self.spark.read.schema(T.StructType([*columns.fields, *directories]))

    def _has_rows(self) -> bool:
        return bool(matching(self.spark, f"{self.rows}/{BUCKET}=*"))

    # -- write ---------------------------------------------------------------------------------

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(CLOSED_ON, F.when(F.col("is_current"), OPEN).otherwise(day_of("end_date")))

    def apply(self, batch: DataFrame, batch_ts: datetime | Column) -> bool:
        """Apply one micro-batch; False when it opened no version, as when it is applied again."""
        self.settle()
        incoming = self.with_bucket(stamp(last_of_batch(batch, self.spec), self.spec, batch_ts)).persist()
        opened = incoming
        try:
            current = None
            if self.exists():
                touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]  # at most one for each bucket
                current = self.stored_in(touched, f"/{CLOSED_ON}={OPEN}") if touched else None
            if current is not None:
                opened = change_detect(incoming, current, self.keys, None, self.spec.nullable).persist()
            days = {r.bucket: r.day for r in opened.groupBy(BUCKET).agg(F.max(day_of("effective_date")).alias("day")).collect()}
            if not days:
                return False
            if current is None:
                self.replace(self._placed(opened))
                return True
            kept = close_versions(current.filter(F.col(BUCKET).isin(*days)), opened, self.keys, self.spec.nullable)
            changed = self._placed(stack(kept.drop(CLOSED_ON), opened))
            same_day = self.stored_in(days, f"/{CLOSED_ON}={max(days.values())}")
            self.replace(changed if same_day is None else stack(changed, same_day))
        finally:
            incoming.unpersist()
            opened.unpersist()
        return True

    def backfill(self, log: DataFrame, effective: str, until: datetime | Column, segment: Column | None = None) -> None:
        """Begin the table with the history of all batches of a change log before ``until``; later batches go on from there."""
        if self.exists():
            raise ValueError(f"{self.path} has rows already")
        at = until if isinstance(until, Column) else F.lit(until)
        self.replace(self._placed(self.with_bucket(rebuild_history(log.filter(F.col(effective) < at), self.spec, effective, segment))))

    # -- read ----------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """Every version of every key."""
        return self._shown(self.stored())

    def _shown(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[c for c in self.spec.layout if c in rows.columns])

    def current(self) -> DataFrame:
        """Current rows only; the directories of closed ones are pruned."""
        return self._shown(self.stored().filter(F.col(CLOSED_ON) == OPEN))

    def view_sql(self, columns: Sequence[str] = ()) -> str:
        """The same rows as ``read`` as a SELECT over the directory, for a view other sessions can query; it needs no renewal."""
        return f"SELECT {', '.join(f'`{c}`' for c in columns or self.read().columns)} FROM parquet.`{self.rows}`"
