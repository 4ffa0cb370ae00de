"""Plain Parquet tables that are divided by a hash of their keys.

The directory of a row says which bucket its key falls into, so a batch reads and replaces only the buckets that its keys fall
into, by partition pruning and Spark's dynamic partition overwrite; the files of other buckets are neither listed nor touched.

    rows/bucket=<n>/...     the table
    pending/bucket=<n>/...  what the last batch was about to put in their place, there only while that happens

A change is written to ``pending`` first. Once that job has committed, the change is certain: it is copied over the table's buckets,
again after a crash as often as it takes, and then removed. One writer per table at a time; a reader may meet buckets of both states
while a change is copied.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.sinks.folders import is_complete, make, matching, remove
from alluvia.sinks.tables import write_new

BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row. Keys count as text, so that it doesn't depend on the width of a number."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class BucketTable:
    """``buckets`` is fixed when a table is first written; a table that exists keeps its own number."""

    levels: tuple[str, ...] = (BUCKET,)

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 16):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.rows, self.pending = f"{self.path}/rows", f"{self.path}/pending"
        self._wanted, self._found = buckets, None

    @property
    def buckets(self) -> int:
        """Kept in the name of an empty directory beside the rows, written with the first change."""
        if self._found is None:
            known = matching(self.spark, f"{self.path}/buckets=*")
            self._found = int(known[0].rsplit("=", 1)[1]) if known else self._wanted
        return self._found

    def exists(self) -> bool:
        self.settle()
        return bool(matching(self.spark, f"{self.rows}/{BUCKET}=*"))

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def reader(self):
        return self.spark.read.option("mergeSchema", "true")

    def stored(self) -> DataFrame:
        """All rows, with the columns that name their directories."""
        if not self.exists():
            raise FileNotFoundError(f"no committed batch under {self.path}")
        return self.reader().parquet(self.rows)

    def stored_in(self, buckets: Iterable[int], below: str = "") -> DataFrame | None:
        """The rows of some buckets (and of one directory ``below`` each): no other directory is listed."""
        places = matching(self.spark, f"{self.rows}/{BUCKET}={{{','.join(map(str, sorted(buckets)))}}}{below}")
        return self.reader().option("basePath", self.rows).parquet(*places) if places else None

    def replace(self, rows: DataFrame) -> None:
        """Put ``rows`` in place of what the directories they fall into hold now."""
        if not matching(self.spark, f"{self.path}/buckets=*"):
            make(self.spark, f"{self.path}/buckets={self.buckets}")
        write_new(rows, self.pending, self.levels)
        self.settle(rows.schema)

    def settle(self, columns: T.StructType | None = None) -> None:
        """Finish a change that had been written when a job died; does nothing otherwise."""
        if not is_complete(self.spark, self.pending):
            return
        # Each file of a change lies in one directory, so copying needs no shuffle.
        reader = self.spark.read if columns is None else self.spark.read.schema(columns)
        change = reader.parquet(self.pending)
        change.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.levels).parquet(self.rows)
        remove(self.spark, self.pending)
