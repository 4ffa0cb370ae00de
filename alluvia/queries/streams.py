"""Structured Streaming over events staged as files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.operators.envelope import decode_messages, to_messages
from alluvia.queries.history import BUCKETS, ORIGIN, PERIOD_SQL, SHOWN, USERS, in_period, period_start, periods
from alluvia.queries.registry import query, table
from alluvia.session import shared_folder
from alluvia.sinks import catalog
from alluvia.sinks.history import HistoryTable
from alluvia.sinks.messages import write_message_files
from alluvia.sinks.tables import load_appended
from alluvia.sources.streams import events_from_rate, read_rate_batches, stream_messages, stream_table
from alluvia.streaming.lifecycle import run_batches
from alluvia.streaming.metrics import BatchMetrics, observed
from alluvia.streaming.sinks import append_handler, append_stream, batch_stream, history_handler
from alluvia.streaming.state import dedup_within


@query("stream_file_source", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_file_source(spark, folder):
    """A table read as a stream, two files per micro-batch."""
    home = shared_folder(spark, "source")
    table(spark, folder, "events").repartition(8).write.parquet(f"{home}/in")
    rows = stream_table(spark, f"{home}/in", max_files=2).select("event_id", "ts", "user_id", "event_type", "value")
    append_stream(rows, f"{home}/out", f"{home}/checkpoint", every=None).awaitTermination()
    return spark.read.parquet(f"{home}/out")


@query("stream_append", """
    SELECT CAST(event_id AS VARCHAR) AS message_key, user_id, event_type, value FROM events""")
def stream_append(spark, folder):
    """Messages decoded and appended with their date parts."""
    home = shared_folder(spark, "append")
    events = table(spark, folder, "events")
    payload = events.select("user_id", "event_type", "value", "event_id", "ts")
    messages = to_messages(payload, F.col("event_id").cast("string"), F.col("ts"))
    write_message_files(messages, f"{home}/in")
    decoded = decode_messages(stream_messages(spark, f"{home}/in"), payload.schema)
    dated = decoded.withColumns({"year": F.year("ts"), "month": F.month("ts")})
    stream = append_stream(dated, f"{home}/out", f"{home}/checkpoint", every=None, partition_by=["year", "month"])
    stream.awaitTermination()
    return spark.read.parquet(f"{home}/out").select("message_key", "user_id", "event_type", "value")


def staged_runs(events, home, start):
    """Stage one period after the other and let the stream catch up each time: one micro-batch per period,
    and a restart from the checkpoint in between."""
    for number in periods(events):
        in_period(events, number).write.mode("append").parquet(f"{home}/in")
        start().awaitTermination()


@query("scd2_stream", PERIOD_SQL)
def scd2_stream(spark, folder):
    home = shared_folder(spark, "scd2")
    events = table(spark, folder, "events")
    stored = HistoryTable(spark, f"{home}/history", USERS, BUCKETS)
    handler = history_handler(stored, batch_time=lambda batch, number: period_start(number))

    def start():
        return batch_stream(stream_table(spark, f"{home}/in", events.schema), handler, f"{home}/checkpoint", every=None)

    staged_runs(events, home, start)
    return stored.read().select(*SHOWN)


@query("partitioned_append", """
    WITH log AS (SELECT *, date_diff('day', TIMESTAMP '2024-01-01', ts) // 5 AS period FROM events)
    SELECT user_id, event_type, ts, event_id, CAST(year(start) AS INTEGER) AS "year", CAST(month(start) AS INTEGER) AS "month",
           CAST(day(start) AS INTEGER) AS "day"
    FROM (SELECT *, TIMESTAMP '2024-01-01' + to_days(CAST(5 * period AS INTEGER)) AS start FROM log
          QUALIFY row_number() OVER (PARTITION BY user_id, event_type, period ORDER BY ts DESC, event_id DESC) = 1)""")
def partitioned_append(spark, folder):
    """Each micro-batch deduplicated on (user, type) and appended below its date."""
    home = shared_folder(spark, "dedup")
    events = table(spark, folder, "events")
    handler = append_handler(
        f"{home}/out", ["user_id", "event_type"], ["user_id", "event_type", "ts", "event_id"], order=("ts",),
        batch_time=lambda batch, number: period_start(number),
    )

    def start():
        return batch_stream(stream_table(spark, f"{home}/in", events.schema), handler, f"{home}/checkpoint", every=None)

    staged_runs(events, home, start)
    return load_appended(spark, f"{home}/out").drop("processed_ts")


HALF = "TIMESTAMP_NTZ '2024-01-16 00:00:00'"


@query("schema_evolution", """
    SELECT CAST(event_id AS VARCHAR) AS message_key, user_id, event_type,
           CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END AS value FROM events""")
def schema_evolution(spark, folder):
    """Messages that come to hold one more field: the stream goes on from its checkpoint, the registered table gets the column."""
    home, name = shared_folder(spark, "evolution"), "alluvia_check.evolving_events"
    events = table(spark, folder, "events")
    old = T.StructType([f for f in events.schema.fields if f.name in ("user_id", "event_type")])
    new = T.StructType([*old.fields, events.schema["value"]])
    catalog.ensure_database(spark, "alluvia_check")
    for payload, part in ((old, events.filter(F.col("ts") < F.expr(HALF))), (new, events.filter(F.col("ts") >= F.expr(HALF)))):
        write_message_files(to_messages(part.select(*payload.names, "event_id"), F.col("event_id").cast("string"), F.current_timestamp(),
                                        payload.names), f"{home}/in")
        decoded = decode_messages(stream_messages(spark, f"{home}/in"), payload)
        append_stream(decoded, f"{home}/bronze", f"{home}/checkpoint", every=None).awaitTermination()
        catalog.register_table(spark, name, f"{home}/bronze")
    return spark.table(name).select("message_key", *new.names)


@query("stream_dedup_watermark", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedup_watermark(spark, folder):
    """Three deliveries of ten days. Each repeats a third of its own rows and a third of the rows before it, and the stream is started
    again for each; ids are forgotten after thirty days of event time."""
    home = shared_folder(spark, "watermark")
    events = table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    decade = F.least(F.floor(F.datediff("ts", F.expr(ORIGIN)) / 10), F.lit(2))
    for number in range(3):
        fresh = events.filter(decade == number)
        again = events.filter((decade.between(number - 1, number)) & (F.col("event_id") % 3 == number))
        fresh.unionByName(again).write.mode("append").parquet(f"{home}/in")
        rows = dedup_within(stream_table(spark, f"{home}/in", events.schema), ["event_id"], "ts", "30 days")
        append_stream(rows, f"{home}/out", f"{home}/checkpoint", every=None).awaitTermination()
    return spark.read.parquet(f"{home}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_metrics", """
    SELECT date_diff('day', TIMESTAMP '2024-01-01', ts) // 5 AS batch_id, count(*) AS "rows", count(*) AS input_rows,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchases, CAST(max(event_id) AS BIGINT) AS last_event
    FROM events GROUP BY ALL""")
def stream_metrics(spark, folder):
    """One row for each micro-batch, told by the running query to a listener while it writes the batch; nothing is read twice."""
    home = shared_folder(spark, "metrics")
    events = table(spark, folder, "events")
    figures = {"purchases": F.count_if(F.col("event_type") == "purchase"), "last_event": F.max(F.col("event_id").cast("long"))}
    kinds = T.StructType([T.StructField(n, T.LongType()) for n in figures])
    with BatchMetrics(spark, "batches", f"{home}/metrics", kinds) as metrics:
        for number in periods(events):
            in_period(events, number).coalesce(1).write.mode("append").parquet(f"{home}/in")
            rows = observed(stream_table(spark, f"{home}/in", events.schema), "batches", figures)
            metrics.wait(append_stream(rows, f"{home}/out", f"{home}/checkpoint", every=None, name="events"))
    return metrics.read().select("batch_id", "rows", "input_rows", *figures)


@query("rate_stream", """
    WITH n AS (SELECT count(*) AS events FROM events), per AS (SELECT CAST(ceil(events / 4.0) AS BIGINT) AS size FROM n)
    SELECT i AS id, 'User_' || i AS name, CASE i % 3 WHEN 0 THEN 'purchase' WHEN 1 THEN 'view' ELSE 'click' END AS event_type,
           CAST(i % 1000 AS INTEGER) AS amount, TIMESTAMP '2024-01-01' + to_seconds(CAST(60 * (i // size) AS BIGINT)) AS ingest_ts
    FROM per, n, range(0, 4 * (SELECT size FROM per)) AS r(i)""")
def rate_stream(spark, folder):
    """As many demo events as there are events, in four micro-batches of an interval trigger, with a restart after the second."""
    home = shared_folder(spark, "rate")
    size = -(-table(spark, folder, "events").count() // 4)
    start = 1_704_067_200_000  # 2024-01-01
    for batches in (2, 4):
        ticks = read_rate_batches(spark, size, start, 60_000)
        rows = events_from_rate(ticks, (F.col("value") % 1000))
        run_batches(append_stream(rows, f"{home}/out", f"{home}/checkpoint", every="100 milliseconds"), batches)
    # The interval may have fired once more than asked.
    made = spark.read.parquet(f"{home}/out").filter(F.col("id") < 4 * size)
    return made.withColumn("ingest_ts", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=F.unix_millis("ingest_ts") / 1000))
