"""Streaming jobs run to the end of their input, and the batch form of the windows."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.operators.versions import VersionedTable
from loomwell.plans.registry import query
from loomwell.session import scratch_path
from loomwell.sources.files import read_json, write_csv, write_json
from loomwell.sources.generate import LABELS, pick
from loomwell.sources.tables import EVENTS, load
from loomwell.streaming import sinks
from loomwell.streaming.event_time import panes, sensor_readings, windowed, windows_from_panes, zoneless
from loomwell.streaming.feeds import dealt_feed, file_feed, in_event_order, stream_session, table_feed, with_event_time
from loomwell.streaming.rows import FailingRowFiles, RowFiles
from loomwell.streaming.state import groups_for, merge_parts, parts_for, running_user_totals, user_sessions

HOUR = """
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
           event_type, count(*) AS events, CAST(sum(CAST(value AS decimal(18,2))) AS double) AS total, max(value) AS largest
    FROM events GROUP BY ALL
"""
SLIDING = """
    WITH e AS (SELECT event_type, value, time_bucket(INTERVAL '30 minutes', ts) - s.i * INTERVAL '30 minutes' AS window_start
               FROM events, (VALUES (0), (1), (2), (3)) s(i))
    SELECT window_start, window_start + INTERVAL '2 hours' AS window_end, event_type, count(*) AS events,
           CAST(sum(CAST(value AS decimal(18,2))) AS double) AS total, max(value) AS largest
    FROM e GROUP BY ALL
"""
# Append mode emits a window once the watermark has passed its end.
FINAL = " WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '{0}'"


def measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("events"),
        F.sum(money("value")).cast("double").alias("total"),
        F.max("value").alias("largest"),
    ]


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    return with_event_time(table_feed(stream_session(spark), d, "events"), "ts")


def ordered_events(spark: SparkSession, d: str, out: str) -> DataFrame:
    """The events in four micro-batches in event order, so that none is late."""
    events = load(spark, d, "events")
    feed = dealt_feed(stream_session(spark), events, f"{out}/feed", in_event_order(events, "ts", 4))
    return with_event_time(feed, "ts")


def flat(df: DataFrame) -> DataFrame:
    return zoneless(df, "window_start", "window_end")


@query("tumbling_window", HOUR)
def tumbling_window(spark: SparkSession, d: str) -> DataFrame:
    return windowed(load(spark, d, "events"), "ts", "1 hour", ["event_type"], measures())


WIDTH, SLIDE = 7200, 1800  # seconds


def mergeable() -> dict[str, tuple[str, Column]]:
    return {"events": ("sum", F.lit(1)), "total": ("sum", money("value")), "largest": ("max", F.col("value"))}


def sliding_from(found: DataFrame) -> DataFrame:
    kinds = {n: kind for n, (kind, _) in mergeable().items()}
    windows = windows_from_panes(found, WIDTH, SLIDE, ["event_type"], kinds)
    return windows.withColumn("total", F.col("total").cast("double"))


@query("sliding_window", SLIDING)
def sliding_window(spark: SparkSession, d: str) -> DataFrame:
    return sliding_from(panes(load(spark, d, "events"), "ts", SLIDE, ["event_type"], mergeable()))


@query("stream_tumbling", HOUR)
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "tumbling")
    hourly = windowed(event_stream(spark, d), "ts", "1 hour", ["event_type"], measures())
    sinks.to_batches(flat(hourly), f"{out}/rows", f"{out}/state", "complete")
    return sinks.last_batch(spark, f"{out}/rows")


WINDOW_KEYS = ["window_start", "window_end", "event_type"]


@query("stream_sliding", SLIDING)
def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    """The stream keeps one state row per pane, not one per window; windows are put together when they are read."""
    out = scratch_path(spark, "sliding")
    found = panes(ordered_events(spark, d, out), "ts", SLIDE, ["event_type"], mergeable(), lateness="1 hour")
    sinks.to_batches(zoneless(found, "window_start"), f"{out}/rows", f"{out}/state", "update")
    return sliding_from(sinks.last_update(spark, f"{out}/rows", ["window_start", "event_type"]))


@query("stream_watermark_append", f"SELECT * FROM ({HOUR}) " + FINAL.format("30 seconds"))
def stream_watermark_append(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "append")
    hourly = windowed(ordered_events(spark, d, out), "ts", "1 hour", ["event_type"], measures(), lateness="30 seconds")
    sinks.to_files(flat(hourly), f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows")


LATE_CUT = """
    (SELECT to_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2 // 3600000000 * 3600)::TIMESTAMP FROM events)
"""


@query(
    "stream_late_rows",
    f"""
    SELECT event_type, CAST(count(*) AS bigint) AS events FROM events WHERE ts >= {LATE_CUT} GROUP BY 1
    """,
)
def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """The later half of the time comes in two micro-batches, then the earlier half, too late by far.

    A micro-batch drops what is older than the watermark with which the one before
    it ran. All portions meet at full hours, so no hourly window holds rows of two.
    """
    out = scratch_path(spark, "late")
    events = load(spark, d, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(micros).alias("low"), F.max(micros).alias("high")).first()
    if ends["low"] is None:
        return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    middle = (ends["low"] + ends["high"]) // 2 // 3_600_000_000 * 3_600_000_000
    recent = (middle + ends["high"]) // 2 // 3_600_000_000 * 3_600_000_000
    portions = [micros >= recent, (micros >= middle) & (micros < recent), micros < middle]
    feed = dealt_feed(stream_session(spark), events, f"{out}/feed", portions)
    hourly = windowed(with_event_time(feed, "ts"), "ts", "1 hour", ["event_type"], measures(), lateness="1 hour")
    sinks.to_batches(flat(hourly), f"{out}/rows", f"{out}/state", "update")
    latest = sinks.last_update(spark, f"{out}/rows", WINDOW_KEYS)
    return latest.groupBy("event_type").agg(F.sum("events").cast("long").alias("events"))


@query("stream_update_latest", "SELECT user_id, count(*) AS events, CAST(sum(CAST(value AS decimal(18,2))) AS double) AS total, max(value) AS largest FROM events GROUP BY 1")
def stream_update_latest(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "update")
    per_user = event_stream(spark, d).groupBy("user_id").agg(*measures())
    sinks.to_batches(per_user, f"{out}/rows", f"{out}/state", "update")
    return sinks.last_update(spark, f"{out}/rows", ["user_id"])


BY_TYPE = """
    SELECT event_type, count(*) AS event_count, CAST(sum(CAST(value AS decimal(18,2))) AS double) AS total_amount
    FROM events GROUP BY 1
"""


def totals_by_type(spark: SparkSession, stream: DataFrame, out: str) -> DataFrame:
    totals = stream.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(money("value")).cast("double").alias("total_amount")
    )
    sinks.to_batches(totals, f"{out}/rows", f"{out}/state", "complete")
    return sinks.last_batch(spark, f"{out}/rows")


def files_per_trigger(spark: SparkSession) -> int:
    """One file per core and batch: enough work for every task, bounded state growth."""
    return spark.sparkContext.defaultParallelism


def csv_feed_totals(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "csv-feed")
    write_csv(load(spark, d, "events").repartition(files_per_trigger(spark) + 1), f"{out}/feed")
    return totals_by_type(spark, file_feed(stream_session(spark), "csv", f"{out}/feed", EVENTS, files_per_trigger(spark)), out)


@query("stream_csv_agg", BY_TYPE)
def stream_csv_agg(spark: SparkSession, d: str) -> DataFrame:
    return csv_feed_totals(spark, d)


@query("stream_json_count", BY_TYPE)
def stream_json_count(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "json-feed")
    write_json(load(spark, d, "events"), f"{out}/feed")
    return totals_by_type(spark, file_feed(stream_session(spark), "json", f"{out}/feed", EVENTS), out)


@query("stream_restart_totals", BY_TYPE)
def stream_restart_totals(spark: SparkSession, d: str) -> DataFrame:
    """A query that fails in the middle of its third micro-batch and is started again from its checkpoint."""
    out = scratch_path(spark, "restart")
    events = load(spark, d, "events").select("event_id", "event_type", "value", "ts")
    feed = dealt_feed(stream_session(spark), events, f"{out}/feed", in_event_order(events, "ts", 4))
    rows = feed.select("event_id", "event_type", "value")
    try:
        sinks.to_rows(rows, FailingRowFiles(f"{out}/rows", epoch=2, after_rows=3), f"{out}/state")
    except StreamingQueryException as e:
        if "fails here on purpose" not in str(e):
            raise
    sinks.to_rows(rows, RowFiles(f"{out}/rows"), f"{out}/state")
    return read_json(spark, f"{out}/rows", rows.schema).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(money("value")).cast("double").alias("total_amount")
    )


@query(
    "stream_stateless",
    """
    SELECT event_id, ['alpha', 'beta', 'gamma', 'delta', 'epsilon'][CAST(event_id % 5 AS int) + 1] AS category,
           upper(event_type) AS event_type, value * 2 AS doubled FROM events
    """,
)
def stream_stateless(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "stateless")
    mapped = table_feed(spark, d, "events").select(
        "event_id",
        pick(LABELS, F.col("event_id")).alias("category"),
        F.upper("event_type").alias("event_type"),
        (F.col("value") * 2).alias("doubled"),
    )
    sinks.to_files(mapped, f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows")


@query("stream_parquet_sink", "SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase'")
def stream_parquet_sink(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "parquet-sink")
    purchases = table_feed(spark, d, "events").filter(F.col("event_type") == "purchase")
    sinks.to_files(purchases.select("event_id", "ts", "user_id", "value"), f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows")


@query("stream_foreach_batch_upsert", "SELECT user_id, count(*) AS events, CAST(sum(CAST(value AS decimal(18,2))) AS double) AS total, max(value) AS largest FROM events GROUP BY 1")
def stream_foreach_batch_upsert(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "upsert-sink")
    table = VersionedTable(spark, f"{out}/table", ["user_id"])
    per_user = event_stream(spark, d).groupBy("user_id").agg(*measures())
    sinks.to_versioned_table(per_user, table, f"{out}/state")
    return table.as_of()


@query(
    "stream_keyed_state",
    """
    SELECT user_id, count(*) AS event_count, CAST(sum(CAST(round(value * 100) AS bigint)) AS bigint) AS value_cents,
           CAST(max(CAST(round(value * 100) AS bigint)) AS bigint) AS largest_cents
    FROM events GROUP BY 1
    """,
)
def stream_keyed_state(spark: SparkSession, d: str) -> DataFrame:
    return keyed_totals(spark, d, F.col("value"))


def keyed_totals(spark: SparkSession, d: str, value: Column) -> DataFrame:
    out = scratch_path(spark, "keyed-state")
    events = load(spark, d, "events")
    feed = dealt_feed(stream_session(spark), events, f"{out}/feed", in_event_order(events, "ts", 2))
    pieces = running_user_totals(feed.withColumn("value", value), parts_for(events))
    sinks.to_batches(pieces, f"{out}/rows", f"{out}/state", "update")
    return merge_parts(sinks.last_update(spark, f"{out}/rows", ["user_id", "part"]))


@query(
    "stream_keyed_state_nulls",
    """
    WITH v AS (SELECT user_id, CASE WHEN user_id % 9 > 0 AND event_id % 4 > 0 THEN CAST(round((value - 1000000) * 100) AS bigint) END AS cents FROM events)
    SELECT user_id, count(*) AS event_count, CAST(sum(cents) AS bigint) AS value_cents, max(cents) AS largest_cents
    FROM v GROUP BY 1
    """,
)
def stream_keyed_state_nulls(spark: SparkSession, d: str) -> DataFrame:
    """All values below zero, and users without any value."""
    known = (F.col("user_id") % 9 > 0) & (F.col("event_id") % 4 > 0)
    return keyed_totals(spark, d, F.when(known, F.col("value") - 1_000_000))


@query(
    "stream_user_sessions",
    """
    WITH e AS (SELECT user_id, epoch_us(ts) AS us, CAST(round(value * 100) AS bigint) AS cents FROM events),
         f AS (SELECT *, coalesce(us - lag(us) OVER (PARTITION BY user_id ORDER BY us) > 43200000000, true) AS fresh FROM e),
         n AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS session FROM f),
         s AS (SELECT user_id, min(us) AS first_us, max(us) AS last_us, count(*) AS events, CAST(sum(cents) AS bigint) AS value_cents
               FROM n GROUP BY user_id, session)
    SELECT * FROM s WHERE last_us + 43200000000 < ((SELECT max(us) FROM e) // 1000 - 7200000) * 1000
    """,
)
def stream_user_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions with a gap of twelve hours that have ended two hours before the newest event."""
    out = scratch_path(spark, "sessions")
    events = load(spark, d, "events")
    feed = dealt_feed(stream_session(spark), events, f"{out}/feed", in_event_order(events, "ts", 4))
    sinks.to_files(user_sessions(feed, "ts", "12 hours", "2 hours", groups_for(events)), f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows")


@query(
    "pipe_stream_windows",
    """
    WITH s AS (SELECT ts, 'sensor_' || ['A', 'B', 'C', 'D'][CAST(event_id % 4 AS int) + 1] AS sensor_id,
                      CAST((event_id * 7919) % 2000 + 2000 AS bigint) AS hundredths FROM events)
    SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
           sensor_id, count(*) AS event_count, CAST(sum(hundredths) AS double) / count(*) / 100 AS avg_temp
    FROM s GROUP BY ALL
    """,
)
def pipe_stream_windows(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "sensors")
    readings = sensor_readings(ordered_events(spark, d, out), "event_id", "ts")
    hundredths = F.sum(F.round(F.col("temperature") * 100).cast("long")).cast("double")
    per_minute = windowed(
        readings,
        "event_time",
        "1 minute",
        ["sensor_id"],
        [F.count(F.lit(1)).alias("event_count"), (hundredths / F.count(F.lit(1)) / 100).alias("avg_temp")],
        lateness="30 seconds",
    )
    sinks.to_batches(flat(per_minute), f"{out}/rows", f"{out}/state", "update")
    return sinks.last_update(spark, f"{out}/rows", ["window_start", "window_end", "sensor_id"])


@query("pipe_stream_totals", BY_TYPE)
def pipe_stream_totals(spark: SparkSession, d: str) -> DataFrame:
    return csv_feed_totals(spark, d).orderBy(F.desc("total_amount"))
