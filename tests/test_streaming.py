import os
import signal
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from alluvia.operators.scd2 import HistorySpec
from alluvia.sinks.history import HistoryTable
from alluvia.sinks.tables import load_appended
from alluvia.sources.streams import read_rate_events, stream_table
from alluvia.streaming import lifecycle, sinks
from alluvia.streaming.metrics import BatchMetrics, observed
from alluvia.streaming.state import dedup_within

DDL = "k int, v string, kafka_timestamp timestamp"
SPEC = HistorySpec(keys=("k",), tracked=("v",), order=("kafka_timestamp",))


def feed(spark, path, rows):
    stamped = [(k, v, datetime(2024, 1, 1, 0, 0, n)) for n, (k, v) in enumerate(rows)]
    spark.createDataFrame(stamped, DDL).coalesce(1).write.mode("append").parquet(path)


def source(spark, here, **bounds):
    return stream_table(spark, f"{here}/in", spark.createDataFrame([], DDL).schema, **bounds)


def test_append_restarts_from_its_checkpoint(spark, here):
    for rows in ([(1, "a")], [(2, "b"), (3, "c")]):
        feed(spark, f"{here}/in", rows)
        for _ in range(2):
            sinks.append_stream(source(spark, here), f"{here}/out", f"{here}/c", None, name="s").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{here}/out").collect()) == [1, 2, 3]


def test_partitioned_append_stream(spark, here):
    feed(spark, f"{here}/in", [(1, "a"), (2, "b")])
    sinks.append_stream(source(spark, here), f"{here}/out", f"{here}/c", None, ["v"]).awaitTermination()
    assert {"v=a", "v=b"} <= set(os.listdir(f"{here}/out"))


def test_micro_batches_are_bounded(spark, here):
    for n in range(4):
        feed(spark, f"{here}/in", [(n, "x")])
    seen = []
    query = sinks.batch_stream(
        source(spark, here, max_files=1), lambda batch, number: seen.append((number, batch.count())), f"{here}/c", None
    )
    query.awaitTermination()
    assert seen == [(0, 1), (1, 1), (2, 1), (3, 1)]
    by_bytes = sinks.batch_stream(source(spark, here, max_bytes=1), lambda b, n: None, f"{here}/c2", None)
    by_bytes.awaitTermination()
    assert by_bytes.lastProgress is not None


def test_history_stream_with_restart_and_forced_replay(spark, here):
    table = HistoryTable(spark, f"{here}/h", SPEC)
    calls = []

    def batch_time(batch, number):
        return datetime(2024, 2, 1 + number)

    handler = sinks.history_handler(table, batch_time)

    def recorded(batch, number):
        calls.append((sinks.stream_id(batch), number))
        handler(batch, number)
        if number == 1 and len(calls) == 2:
            raise RuntimeError("killed after the write")

    for rows, fails in (([(1, "a"), (2, "a")], False), ([(1, "b"), (1, "c")], True)):
        feed(spark, f"{here}/in", rows)
        query = sinks.batch_stream(source(spark, here), recorded, f"{here}/c", None)
        if fails:
            with pytest.raises(Exception, match="killed after the write"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    sinks.batch_stream(source(spark, here), recorded, f"{here}/c", None).awaitTermination()
    assert [number for _, number in calls] == [0, 1, 1]
    assert len({stream for stream, _ in calls}) == 1 and calls[0][0] != "batch"
    got = sorted((r.k, r.v, r.is_current, r.effective_date.day) for r in table.read().collect())
    assert got == [(1, "a", False, 1), (1, "c", True, 2), (2, "a", True, 1)]


def test_append_handler(spark, here):
    fixed = lambda batch, number: datetime(2024, 3, 1 + number)
    stamped = lambda rows: spark.createDataFrame(
        [(k, v, datetime(2024, 1, 1, 0, 0, n)) for n, (k, v) in enumerate(rows)], DDL
    )
    plain = sinks.append_handler(f"{here}/a", ["k"], ["k", "v"], batch_time=fixed)
    strict = sinks.append_handler(f"{here}/b", ["k"], ["k", "v"], batch_time=fixed, cross_batch=True)
    for handle in (plain, strict):
        handle(stamped([(1, "a"), (1, "b"), (None, "c")]), 0)
        handle(stamped([(1, "z"), (2, "d")]), 1)
        handle(stamped([(1, "z"), (2, "d")]), 1)
    rows = load_appended(spark, f"{here}/a")
    assert sorted((r.k, r.v, r.day) for r in rows.collect()) == [(1, "b", 1), (1, "z", 2), (2, "d", 2)]
    assert sorted((r.k, r.v) for r in load_appended(spark, f"{here}/b").collect()) == [(1, "b"), (2, "d")]
    assert rows.columns == ["k", "v", "processed_ts", "year", "month", "day"]


def test_fan_out_reads_the_source_once(spark, here):
    feed(spark, f"{here}/in", [(1, "a"), (2, "b")])
    first, second = [], []
    handler = sinks.fan_out(
        lambda batch, number: first.extend(r.k for r in batch.collect()),
        lambda batch, number: second.append(batch.count()),
    )
    query = sinks.batch_stream(source(spark, here), handler, f"{here}/c", None)
    query.awaitTermination()
    # Rows that a second action reads again from the source are counted again.
    read = sum(update["numInputRows"] for update in query.recentProgress)
    assert (sorted(first), second, read) == ([1, 2], [2], 2)


def test_memory_sink_and_rate_source(spark, here):
    query = read_rate_events(spark, 200).writeStream.format("memory").queryName("rate_rows").start()
    try:
        while not query.lastProgress or not query.lastProgress["numInputRows"]:
            query.processAllAvailable()
        assert lifecycle.status_line(query)["active"] is True
        assert lifecycle.status_line(query)["input_rows"] > 0
    finally:
        assert lifecycle.stop_all([query]) == []
    rows = spark.table("rate_rows")
    assert rows.filter((F.col("amount") < 0) | (F.col("amount") >= 1000)).count() == 0
    assert not lifecycle.status_line(query)["active"]


def test_console_stream(spark, here):
    feed(spark, f"{here}/in", [(1, "a")])
    sinks.console_stream(source(spark, here), f"{here}/c", None, "watch").awaitTermination()


def test_progress_rows(spark, here):
    feed(spark, f"{here}/in", [(1, "a"), (2, "b")])
    query = sinks.append_stream(source(spark, here), f"{here}/out", f"{here}/c", None, name="counted")
    query.awaitTermination()
    frame = lifecycle.progress(spark, query)
    assert frame.agg(F.sum("input_rows")).first()[0] == 2
    assert frame.first().name == "counted"


def endless(spark, here, name):
    return sinks.append_stream(source(spark, here), f"{here}/{name}", f"{here}/c_{name}", "1 second", name=name)


def test_signal_stops_the_registered_queries(spark, here):
    feed(spark, f"{here}/in", [(1, "a")])
    before = signal.getsignal(signal.SIGTERM)
    with lifecycle.StopOnSignal(endless(spark, here, "one")) as guard:
        guard.add(endless(spark, here, "two"))
        os.kill(os.getpid(), signal.SIGTERM)
        lifecycle.watch(spark, guard.queries, look_every=1)
        assert guard.received == signal.SIGTERM
        assert not any(q.isActive for q in guard.queries)
    assert signal.getsignal(signal.SIGTERM) is before


@pytest.mark.parametrize("bad_first", [True, False])
def test_one_failure_stops_the_others(spark, here, bad_first):
    feed(spark, f"{here}/in", [(1, "a")])
    good = endless(spark, here, "good")

    def fail(batch, number):
        raise RuntimeError("bad batch")

    bad = sinks.batch_stream(source(spark, here), fail, f"{here}/c_bad", None)
    problems = []
    lifecycle.watch(spark, (bad, good) if bad_first else (good, bad), on_failure=problems.append, look_every=1)
    assert "bad batch" in str(problems[0]) and not good.isActive and not bad.isActive


def test_watch_raises_without_a_handler(spark, here):
    feed(spark, f"{here}/in", [(1, "a")])

    def fail(batch, number):
        raise RuntimeError("bad batch")

    good = endless(spark, here, "good")
    with pytest.raises(Exception, match="bad batch"):
        lifecycle.watch(spark, [good, sinks.batch_stream(source(spark, here), fail, f"{here}/c_bad", None)], look_every=1)
    with pytest.raises(Exception, match="bad batch"):
        lifecycle.run_together(
            spark,
            [lambda: endless(spark, here, "good2"), lambda: sinks.batch_stream(source(spark, here), fail, f"{here}/c_bad2", None)],
        )
    assert not [q for q in spark.streams.active]


def test_in_turn(spark, here):
    feed(spark, f"{here}/in", [(1, "a")])
    order = []

    def starter(name):
        def start():
            order.append(name)
            return sinks.append_stream(source(spark, here), f"{here}/{name}", f"{here}/c{name}", None)

        return start

    lifecycle.run_in_turn([starter("x"), starter("y")])
    assert order == ["x", "y"] and spark.read.parquet(f"{here}/y").count() == 1


def test_streams_run_together_in_a_session_that_had_streams(spark, here):
    feed(spark, f"{here}/in", [(1, "a")])
    sinks.append_stream(source(spark, here), f"{here}/before", f"{here}/c_before", None).awaitTermination()
    began, slow = time.time(), []

    def pause(batch, number):
        time.sleep(3)
        slow.append(number)

    lifecycle.run_together(spark, [
        lambda: sinks.batch_stream(source(spark, here), pause, f"{here}/c_slow", None),
        lambda: sinks.append_stream(source(spark, here), f"{here}/quick", f"{here}/c_quick", None)])
    assert slow == [0] and time.time() - began >= 3
    assert spark.read.parquet(f"{here}/quick").count() == 1


def test_state_is_forgotten_after_the_delay(spark, here):
    ddl = "k int, at timestamp"

    def deliver(*rows):
        spark.createDataFrame([(k, datetime(2024, 1, day)) for k, day in rows], ddl).coalesce(1).write.mode("append").parquet(f"{here}/in")
        stream = stream_table(spark, f"{here}/in", spark.createDataFrame([], ddl).schema)
        sinks.append_stream(dedup_within(stream, ["k"], "at", "5 days"), f"{here}/out", f"{here}/c", None).awaitTermination()
        return sorted((r.k or 0, r["at"].day) for r in spark.read.parquet(f"{here}/out").collect())

    assert deliver((1, 1), (1, 1), (None, 1), (None, 1)) == [(0, 1), (1, 1)]
    assert deliver((1, 2), (2, 3)) == [(0, 1), (1, 1), (2, 3)]  # known after the restart
    assert deliver((3, 20), (1, 4)) == [(0, 1), (1, 1), (2, 3), (3, 20)]
    assert deliver((4, 2), (1, 21)) == [(0, 1), (1, 1), (1, 21), (2, 3), (3, 20)]  # too old; forgotten, so it counts anew


def test_metrics_are_rows_of_a_table(spark, here):
    kinds = spark.createDataFrame([], "least int").schema
    with BatchMetrics(spark, "seen", f"{here}/m", kinds) as metrics:
        for rows in ([(5, "a"), (3, "b")], [(7, "c")], []):
            feed(spark, f"{here}/in", rows)
            stream = observed(source(spark, here), "seen", {"least": F.min("k")})
            assert metrics.wait(sinks.append_stream(stream, f"{here}/out", f"{here}/c", None, name="n"))
        assert metrics.flush() >= 2 and metrics.flush() == 0
    got = {r.batch_id: (r.query, r.rows, r.least) for r in metrics.read().collect()}
    assert got[0] == ("n", 2, 3) and got[1] == ("n", 1, 7)
