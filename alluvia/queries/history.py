"""Type-2 history of users: the tracked attribute is the type of a user's last event in a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.operators import scd2
from alluvia.queries.registry import query, table
from alluvia.session import shared_folder
from alluvia.sinks.history import HistoryTable

USERS = scd2.HistorySpec(keys=("user_id",), tracked=("event_type",), carried=("event_id",), order=("ts", "event_id"))
ORIGIN = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"
PERIOD_DAYS = 5
BUCKETS = 4

SHOWN = [
    "user_id", "event_type", "is_current", "effective_date", "end_date", "hash_key", "event_id", "processed_ts",
    "year", "month", "day",
]


def history_sql(batch: str) -> str:
    """The oracle: last row per (user, batch), keep changes, end each version where the next begins."""
    return f"""
    WITH log AS (SELECT *, {batch} AS effective_date FROM events),
    last AS (SELECT * FROM log QUALIFY row_number() OVER (
                 PARTITION BY user_id, effective_date ORDER BY ts DESC, event_id DESC) = 1),
    compared AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY effective_date) AS earlier FROM last),
    versions AS (SELECT *, lead(effective_date) OVER (PARTITION BY user_id ORDER BY effective_date) AS end_date
                 FROM compared WHERE earlier IS NULL OR earlier <> event_type)
    SELECT user_id, event_type, end_date IS NULL AS is_current, effective_date, end_date,
           sha256(event_type) AS hash_key, event_id, effective_date AS processed_ts,
           CAST(year(effective_date) AS INTEGER) AS "year", CAST(month(effective_date) AS INTEGER) AS "month",
           CAST(day(effective_date) AS INTEGER) AS "day"
    FROM versions"""


DAILY_SQL = history_sql("date_trunc('day', ts)")
PERIOD_SQL = history_sql(
    f"TIMESTAMP '2024-01-01' + to_days(CAST({PERIOD_DAYS} * (date_diff('day', TIMESTAMP '2024-01-01', ts) // {PERIOD_DAYS})"
    " AS INTEGER))"
)


def period_start(number: int):
    return F.expr(f"{ORIGIN} + INTERVAL '{number * PERIOD_DAYS}' DAY")


def in_period(events, number: int):
    """Events of one five-day period; the bounds on ``ts`` reach the scan."""
    return events.filter((F.col("ts") >= period_start(number)) & (F.col("ts") < period_start(number + 1)))


def periods(events) -> range:
    days = events.agg(F.max(F.datediff("ts", F.expr(ORIGIN)))).first()[0]
    return range(days // PERIOD_DAYS + 1)


def daily_log(spark, folder):
    return table(spark, folder, "events").withColumn("at", F.to_date("ts").cast("timestamp_ntz"))


@query("scd2_history", DAILY_SQL)
def scd2_history(spark, folder):
    return scd2.rebuild_history(daily_log(spark, folder), USERS, "at").select(*SHOWN)


@query("scd2_history_segmented", DAILY_SQL)
def scd2_history_segmented(spark, folder):
    """The same rows by way of week segments, for logs where one key has too many batches for one task."""
    weeks = F.floor(F.datediff("at", F.expr(ORIGIN)) / 7)
    return scd2.rebuild_history(daily_log(spark, folder), USERS, "at", segment=weeks).select(*SHOWN)


def two_batches(spark, folder):
    """The first half of the month as stored history, the second half as the batch to apply."""
    log = table(spark, folder, "events")
    half = F.expr(f"{ORIGIN} + INTERVAL '15' DAY")
    stored = scd2.stamp(scd2.last_of_batch(log.filter(F.col("ts") < half), USERS), USERS, F.expr(ORIGIN))
    inserted = scd2.versions_to_insert(log.filter(F.col("ts") >= half), stored, USERS, half)
    return stored, inserted


HALVES_SQL = f"""
    WITH versions AS ({history_sql("CASE WHEN ts < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-16' END")})
    SELECT * FROM versions"""


@query("scd2_close", HALVES_SQL + " WHERE effective_date = TIMESTAMP '2024-01-01'")
def scd2_close(spark, folder):
    stored, inserted = two_batches(spark, folder)
    return scd2.close_versions(stored, inserted, list(USERS.keys)).select(*SHOWN)


@query("scd2_insert", HALVES_SQL + " WHERE effective_date = TIMESTAMP '2024-01-16'")
def scd2_insert(spark, folder):
    return two_batches(spark, folder)[1].select(*SHOWN)


@query("scd2_incremental", PERIOD_SQL)
def scd2_incremental(spark, folder):
    """Period after period into a stored table."""
    events = table(spark, folder, "events")
    stored = HistoryTable(spark, shared_folder(spark, "history"), USERS, BUCKETS)
    for number in periods(events):
        stored.apply(in_period(events, number), period_start(number))
    return stored.read().select(*SHOWN)


@query("scd2_backfill", PERIOD_SQL)
def scd2_backfill(spark, folder):
    """The first half of the log rebuilt into the stored table in one pass, the periods after it applied batch by batch."""
    events = table(spark, folder, "events")
    numbers = periods(events)
    half = len(numbers) // 2
    number = F.floor(F.datediff("ts", F.expr(ORIGIN)) / PERIOD_DAYS)
    log = events.withColumn("at", F.expr(ORIGIN) + F.make_dt_interval(days=(number * PERIOD_DAYS).cast("int")))
    stored = HistoryTable(spark, shared_folder(spark, "backfill"), USERS, BUCKETS)
    stored.backfill(log, "at", period_start(half))
    for later in numbers[half:]:
        stored.apply(in_period(events, later), period_start(later))
    return stored.read().select(*SHOWN)
