"""Running several queries together, stopping them cleanly, and reading their progress."""

from __future__ import annotations

import json
import signal
import time
from collections.abc import Callable, Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = """
    name STRING, id STRING, batch_id BIGINT, timestamp STRING, input_rows BIGINT,
    input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE, duration_ms BIGINT"""


def stop_all(queries: Iterable[StreamingQuery]) -> list[tuple[StreamingQuery, Exception]]:
    """Stop whatever still runs; returns the queries that refused, with the reason."""
    refused = []
    for query in queries:
        try:
            if query.isActive:
                query.stop()
        except Exception as problem:  # one stubborn query must not keep the others running
            refused.append((query, problem))
    return refused


class StopOnSignal:
    """Within the block, SIGINT and SIGTERM stop the registered queries; earlier handlers come back after."""

    SIGNALS = (signal.SIGINT, signal.SIGTERM)

    def __init__(self, *queries: StreamingQuery):
        self.queries = list(queries)
        self.received: int | None = None
        self._earlier: dict[int, object] = {}

    def add(self, query: StreamingQuery) -> StreamingQuery:
        self.queries.append(query)
        return query

    def __enter__(self) -> StopOnSignal:
        self._earlier = {number: signal.signal(number, self._stop) for number in self.SIGNALS}
        return self

    def __exit__(self, *_) -> None:
        for number, handler in self._earlier.items():
            signal.signal(number, handler)

    def _stop(self, number: int, frame) -> None:
        self.received = number
        stop_all(self.queries)


def ended_badly(queries: Iterable[StreamingQuery]) -> Exception | None:
    """The failure of a query that has ended with one."""
    return next((problem for q in queries if not q.isActive and (problem := q.exception()) is not None), None)


def watch(
    spark: SparkSession, queries: Iterable[StreamingQuery], on_failure: Callable[[Exception], None] | None = None,
    look_every: float = 5,
) -> None:
    """Return once none of the queries is active. The first failure, whichever query has it, stops the others at once.

    The session reports that *some* query has ended, so no query is waited for in particular: each report is followed by a look at
    all of them. Queries of the session that are not watched may end meanwhile. A failure is raised unless ``on_failure`` takes it.
    """
    watched = list(queries)
    try:
        while any(q.isActive for q in watched) and ended_badly(watched) is None:
            spark.streams.resetTerminated()
            if all(q.isActive for q in watched):  # else one ended before the reset and would not be reported again
                try:
                    spark.streams.awaitAnyTermination(look_every)
                except StreamingQueryException:
                    continue  # found by the look at all queries, if it is one of them
            else:
                time.sleep(min(look_every, 0.2))
    finally:
        stop_all(watched)
    problem = ended_badly(watched)
    if problem is not None:
        if on_failure is None:
            raise problem
        on_failure(problem)


def run_together(spark: SparkSession, starters: Iterable[Callable[[], StreamingQuery]]) -> None:
    """Start all queries and wait until all have ended; the first failure stops the others and is raised."""
    with StopOnSignal() as guard:
        try:
            for start in starters:
                guard.add(start())
            watch(spark, guard.queries)
        finally:
            stop_all(guard.queries)


def run_in_turn(starters: Iterable[Callable[[], StreamingQuery]]) -> None:
    """Catch up one stream after the other; the starters use the available-now trigger."""
    with StopOnSignal() as guard:
        for start in starters:
            guard.add(start()).awaitTermination()
            if guard.received is not None:
                return


def run_batches(query: StreamingQuery, batches: int, look_every: float = 0.1) -> StreamingQuery:
    """Let a query with an interval trigger finish at least ``batches`` micro-batches, then stop it. A failure is raised."""
    try:
        while query.isActive and ((latest := query.lastProgress) is None or latest["batchId"] < batches - 1):
            time.sleep(look_every)
    finally:
        stop_all([query])
    problem = query.exception()
    if problem is not None:
        raise problem
    return query


def progress(spark: SparkSession, *queries: StreamingQuery) -> DataFrame:
    """The recent micro-batches of the queries, one row each (Spark keeps a bounded number)."""
    rows = []
    for query in queries:
        for update in query.recentProgress:
            seen = update if isinstance(update, dict) else json.loads(update.json)
            rows.append((
                seen.get("name"), str(seen.get("id")), seen.get("batchId"), seen.get("timestamp"),
                seen.get("numInputRows"), seen.get("inputRowsPerSecond"), seen.get("processedRowsPerSecond"),
                seen.get("durationMs", {}).get("triggerExecution"),
            ))
    return spark.createDataFrame(rows, PROGRESS)


def status_line(query: StreamingQuery) -> dict[str, object]:
    """What a query is doing right now, with the row count of its latest micro-batch."""
    latest = query.lastProgress
    seen = {} if latest is None else latest if isinstance(latest, dict) else json.loads(latest.json)
    return {
        "id": str(query.id),
        "name": query.name,
        "active": query.isActive,
        "message": query.status["message"],
        "input_rows": seen.get("numInputRows"),
    }
