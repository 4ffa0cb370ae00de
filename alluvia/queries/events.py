"""Scans, labels, time parts and reports on ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.functions.audit import with_audit
from alluvia.operators import envelope, profile, reports, rows
from alluvia.queries.registry import query, table
from alluvia.schemas import LONG, STRING, record
from alluvia.sources.streams import events_from_rate

# The usual bounds of the revenue tiers are far above the test values; these split them evenly.
BOUNDS = [(20, "low"), (60, "medium"), (90, "high")]
BATCH_TS = "TIMESTAMP_NTZ '2024-02-01 00:00:00'"

TIER_SQL = "CASE WHEN value < 20 THEN 'low' WHEN value < 60 THEN 'medium' WHEN value < 90 THEN 'high' ELSE 'premium' END"


def tiered(spark, folder):
    events = table(spark, folder, "events")
    return events.withColumn("revenue_tier", reports.revenue_tier(F.col("value"), BOUNDS))


@query("scan_table", """
    SELECT event_id, user_id AS userid, event_type AS kind, value FROM events
    WHERE event_type = 'purchase' AND value >= 50""")
def scan_table(spark, folder):
    events = table(spark, folder, "events").filter("event_type = 'purchase' AND value >= 50")
    return events.select("event_id", F.col("user_id").alias("userid"), F.col("event_type").alias("kind"), "value")


@query("required_keys", """
    SELECT n AS user_id, event_type, event_id
    FROM (SELECT *, CASE WHEN value < 10 THEN NULL ELSE user_id END AS n FROM events)
    WHERE n IS NOT NULL AND event_type IS NOT NULL""")
def required_keys(spark, folder):
    # Keys go missing where the value is small, as they do in damaged messages.
    keyed = table(spark, folder, "events").select(
        F.when(F.col("value") >= 10, F.col("user_id")).alias("user_id"), "event_type", "event_id"
    )
    return rows.required_keys(keyed, ["user_id", "event_type"])


@query("topk_latest", "SELECT * FROM events ORDER BY event_id DESC LIMIT 10")
def topk_latest(spark, folder):
    return reports.top_rows(table(spark, folder, "events"), ["event_id"])


@query("agg_count", "SELECT count(*) AS total_records FROM events")
def agg_count(spark, folder):
    return reports.total(table(spark, folder, "events"))


@query("agg_count_by", 'SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type')
def agg_count_by(spark, folder):
    return reports.count_by(table(spark, folder, "events"), ["event_type"], by_count=True)


@query("agg_tier_stats", f"""
    SELECT revenue_tier, count(*) AS "count",
           round(avg(value), 6) AS avg_amount
    FROM (SELECT *, {TIER_SQL} AS revenue_tier FROM events) GROUP BY revenue_tier""")
def agg_tier_stats(spark, folder):
    # Averages of all digits; only the result is rounded, as additions come in another order on each side.
    return reports.tier_stats(tiered(spark, folder), "revenue_tier", "value").withColumn("avg_amount", F.round("avg_amount", 6))


@query("agg_two_keys", f"""
    SELECT event_type, revenue_tier, count(*) AS "count"
    FROM (SELECT *, {TIER_SQL} AS revenue_tier FROM events) GROUP BY event_type, revenue_tier""")
def agg_two_keys(spark, folder):
    return reports.count_by(tiered(spark, folder), ["event_type", "revenue_tier"])


@query("agg_min_avg_max", """
    SELECT round(avg(value), 6) AS avg_value,
           min(value) AS min_value, max(value) AS max_value FROM events""")
def agg_min_avg_max(spark, folder):
    return reports.value_range(table(spark, folder, "events"), "value", "value").withColumn("avg_value", F.round("avg_value", 6))


@query("distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_keys(spark, folder):
    return rows.distinct_keys(table(spark, folder, "events"), ["user_id", "event_type"])


@query("revenue_tier", f"SELECT event_id, value, {TIER_SQL} AS revenue_tier FROM events")
def revenue_tier(spark, folder):
    return tiered(spark, folder).select("event_id", "value", "revenue_tier")


@query("time_parts", """
    SELECT event_id, dayofweek(ts) + 1 AS day_of_week, hour(ts) AS hour_of_day FROM events""")
def time_parts(spark, folder):
    events = table(spark, folder, "events")
    return events.select(
        "event_id",
        F.dayofweek("ts").cast("bigint").alias("day_of_week"),
        F.hour("ts").cast("bigint").alias("hour_of_day"),
    )


@query("processing_delay", """
    SELECT event_id,
           date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-02-01 00:00:00') AS delay_seconds
    FROM events""")
def processing_delay(spark, folder):
    delay = reports.delay_seconds(F.expr(BATCH_TS), F.col("ts"))
    return table(spark, folder, "events").select("event_id", delay.alias("delay_seconds"))


@query("enriched_events", f"""
    SELECT event_id, event_type, value, {TIER_SQL} AS revenue_tier, dayofweek(ts) + 1 AS day_of_week,
           hour(ts) AS hour_of_day,
           date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-02-01 00:00:00') AS processing_delay_seconds
    FROM events""")
def enriched_events(spark, folder):
    enriched = reports.enrich_events(
        table(spark, folder, "events"), F.expr(BATCH_TS), amount="value", time="ts", bounds=BOUNDS
    )
    return enriched.select(
        "event_id", "event_type", "value", "revenue_tier",
        F.col("day_of_week").cast("bigint").alias("day_of_week"),
        F.col("hour_of_day").cast("bigint").alias("hour_of_day"),
        "processing_delay_seconds",
    )


@query("audit_columns", """
    SELECT event_id, TIMESTAMP '2024-02-01 00:00:00' AS processed_ts, 2024 AS "year", 2 AS "month", 1 AS "day",
           strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0') AS stamp
    FROM events""")
def audit_columns(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.date_format("ts", "yyyyMMddHHmmssSSS").alias("stamp")
    )
    return with_audit(events, F.expr(BATCH_TS))


@query("json_envelope_parse", """
    SELECT CAST(event_id AS VARCHAR) AS message_key, ts AS kafka_timestamp,
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
           CAST(NULL AS VARCHAR) AS absent
    FROM events""")
def json_envelope_parse(spark, folder):
    # Error events get a truncated payload: their rows stay, with NULL fields.
    messages = table(spark, folder, "events").select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(F.col("props"))
        .cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )
    return envelope.decode_messages(messages, record((LONG, "k"), (STRING, "absent")))


@query("json_key_profile", """
    SELECT u.key AS "key", u.kind AS kind, count(*) AS documents, min(u.size) AS min_size, max(u.size) AS max_size,
           min(u.sample) AS sample
    FROM (
        SELECT unnest([
            {'key': 'id', 'kind': 'scalar', 'size': CAST(NULL AS BIGINT), 'sample': 'bigint'},
            {'key': 'type', 'kind': 'scalar', 'size': CAST(NULL AS BIGINT), 'sample': 'string'},
            {'key': 'props', 'kind': 'dict', 'size': CAST(len(json_keys(props)) AS BIGINT),
             'sample': array_to_string(json_keys(props), ', ')},
            {'key': 'parts', 'kind': 'list', 'size': CAST(len(event_type) AS BIGINT),
             'sample': 'letter, place'}]) AS u
        FROM events)
    GROUP BY 1, 2""")
def json_key_profile(spark, folder):
    letters = F.split("event_type", "")
    parts = F.transform(letters, lambda c, i: F.struct(c.alias("letter"), i.alias("place")))
    documents = table(spark, folder, "events").select(F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        F.from_json("props", "k BIGINT").alias("props"),
        parts.alias("parts"),
    )).alias("body"))
    found = profile.json_key_profile(documents)
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("min_size", "max_size")})


@query("rate_events", """
    SELECT event_id AS id, 'User_' || event_id AS name,
           CASE event_id % 3 WHEN 0 THEN 'purchase' WHEN 1 THEN 'view' ELSE 'click' END AS event_type,
           CAST((event_id * 7919) % 1000 AS INTEGER) AS amount, ts AS ingest_ts
    FROM events""")
def rate_events(spark, folder):
    # The event ids play the counter of the rate source, and a fixed formula its random amounts.
    ticks = table(spark, folder, "events").select(F.col("event_id").alias("value"), F.col("ts").alias("timestamp"))
    return events_from_rate(ticks, amount=F.pmod(F.col("value") * 7919, F.lit(1000)))
