"""A stored table with update-all / insert-all semantics: an upsert rewrites the buckets of its keys and no other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from alluvia.operators.changes import upsert_merge
from alluvia.operators.rows import latest_per_key
from alluvia.sinks.buckets import BUCKET, BucketTable


class UpsertTable(BucketTable):
    def upsert(self, rows: DataFrame, order: Sequence[str] = ()) -> bool:
        """Add the last row per key; False when there was none. Doing it again changes nothing. NULL is a key like any other."""
        self.settle()
        source = self.with_bucket(latest_per_key(rows, self.keys, order)).persist()
        try:
            touched = [r[0] for r in source.select(BUCKET).distinct().collect()]  # at most one for each bucket
            if not touched:
                return False
            stored = self.stored_in(touched)
            self.replace(source if stored is None else upsert_merge(stored, source, self.keys, self.keys))
        finally:
            source.unpersist()
        return True

    def read(self) -> DataFrame:
        return self.stored().drop(BUCKET)
