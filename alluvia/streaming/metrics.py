"""Figures of micro-batches, computed while the batch is written anyway and kept as a table."""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

HEAD = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("started", T.StringType()), T.StructField("input_rows", T.LongType()),
])


def observed(df: DataFrame, name: str, figures: dict[str, Column]) -> DataFrame:
    """``df`` with aggregates that Spark works out as its rows pass; reading the rows a second time is not needed."""
    return df.observe(name, *[F.expr("count(1)").alias("rows"), *[c.alias(n) for n, c in figures.items()]])


class BatchMetrics(StreamingQueryListener):
    """Collects the figures observed under ``name`` from all queries of a session.

    Spark calls a listener on a thread of its own, so it only notes what it is told; ``flush`` writes what has come since as rows of a
    table. Notes are as many as batches between two flushes.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, figures: T.StructType):
        self.spark, self.name, self.path = spark, name, path
        self.figures = T.StructType([T.StructField("rows", T.LongType()), *figures.fields])
        self.notes: deque[tuple] = deque()
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> BatchMetrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.flush()
        self.spark.streams.removeListener(self)

    def _end(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        told = event.progress
        figures: Row | None = told.observedMetrics.get(self.name)
        if figures is not None:
            found = figures.asDict()
            self.notes.append((told.name, str(told.runId), told.batchId, told.timestamp, told.numInputRows,
                               *(found.get(f.name) for f in self.figures.fields)))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout: float = 60) -> bool:
        """Until a query has ended and all its batches have been told; False when that takes too long."""
        query.awaitTermination()
        return self._end(str(query.runId)).wait(timeout)

    def flush(self) -> int:
        """Write the notes so far; returns their number. A batch that was replayed is told again, under another run."""
        rows = []
        while self.notes:
            rows.append(self.notes.popleft())
        if rows:
            schema = T.StructType([*HEAD.fields, *self.figures.fields])
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)

    def read(self) -> DataFrame:
        """The table: of a batch that was told by several runs, the last one's row."""
        rows = self.spark.read.parquet(self.path)
        last = rows.groupBy("query", "batch_id").agg(F.max_by(F.struct(*rows.columns), "started").alias("last"))
        return last.select("last.*")
