"""Streaming semantics: modes, watermarks, restarts, triggers, state stores."""

import datetime
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from loomwell.operators.layout import plan_text
from loomwell.operators.versions import VersionedTable
from loomwell.session import scratch_path
from loomwell.sources.tables import EVENTS
from loomwell.streaming import sinks
from loomwell.streaming.event_time import panes, sensor_readings, windowed, windows_from_panes
from loomwell.streaming.feeds import file_feed, in_event_order, rate_feed, stream_session
from loomwell.streaming.rows import FailingRowFiles, RowFiles
from loomwell.streaming.state import chained, spans_of, user_sessions

READING = "ts timestamp, sensor string, temp double"


def drop_file(spark, folder, name, data, age):
    """One JSON file with a chosen age, since a file stream reads the oldest first."""
    part = f"{folder}-{name}"
    spark.createDataFrame(data, "ts string, sensor string, temp double").coalesce(1).write.json(part)
    os.makedirs(folder, exist_ok=True)
    source = next(f for f in os.listdir(part) if f.endswith(".json"))
    target = os.path.join(folder, f"{name}.json")
    os.link(os.path.join(part, source), target)
    stamp = time.time() - age
    os.utime(target, (stamp, stamp))


@pytest.fixture()
def base(spark):
    return scratch_path(spark, "stream-test").removeprefix("file:")


def per_minute(stream, lateness="30 seconds"):
    return windowed(stream, "ts", "1 minute", ["sensor"], [F.count(F.lit(1)).alias("n")], lateness=lateness)


def feed(spark, base, per_trigger=1):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(READING)
    return file_feed(stream_session(spark), "json", f"{base}/in", schema, per_trigger)


def test_late_rows_kept_inside_and_dropped_beyond_the_watermark(spark, base, rows):
    drop_file(spark, f"{base}/in", "1", [("2024-01-01 00:00:10", "A", 1.0), ("2024-01-01 00:01:20", "A", 2.0)], 300)
    # watermark is now 00:00:50: the first is late but inside, its window is still open
    drop_file(spark, f"{base}/in", "2", [("2024-01-01 00:00:55", "A", 3.0), ("2024-01-01 00:03:00", "A", 4.0)], 200)
    # a batch drops rows behind the watermark its predecessor started with, so one more batch is
    # needed before the row in the last file counts as late for its long finished window
    drop_file(spark, f"{base}/in", "3", [("2024-01-01 00:04:00", "A", 5.0)], 100)
    drop_file(spark, f"{base}/in", "4", [("2024-01-01 00:00:30", "A", 6.0), ("2024-01-01 00:09:00", "A", 7.0)], 50)
    sinks.to_files(per_minute(feed(spark, base)), f"{base}/out", f"{base}/state")
    out = spark.read.parquet(f"{base}/out").select(F.date_format("window_start", "HH:mm").alias("w"), "n")
    assert rows(out) == [("00:00", 2), ("00:01", 1), ("00:03", 1), ("00:04", 1)]


def test_restart_reads_only_new_files(spark, base):
    drop_file(spark, f"{base}/in", "1", [("2024-01-01 00:00:10", "A", 1.0)], 300)
    stream = feed(spark, base).select("sensor", "temp")
    for expected in (1, 1):
        sinks.to_files(stream, f"{base}/out", f"{base}/state")
        assert spark.read.parquet(f"{base}/out").count() == expected
    drop_file(spark, f"{base}/in", "2", [("2024-01-01 00:00:20", "B", 2.0)], 200)
    sinks.to_files(stream, f"{base}/out", f"{base}/state")
    assert spark.read.parquet(f"{base}/out").count() == 2


@pytest.mark.parametrize(
    "provider",
    ["hdfs_backed", "rocksdb"],
)
def test_complete_and_update_modes_on_both_state_stores(spark, base, rows, provider):
    classes = {
        "hdfs_backed": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
        "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for i, name in enumerate("123"):
        drop_file(spark, f"{base}/in", name, [(f"2024-01-01 00:0{i}:10", "AB"[i % 2], float(i))], 300 - i * 50)
    stream = feed(spark, base)
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", classes[provider])
    totals = stream.groupBy("sensor").agg(F.sum("temp").alias("total"), F.count(F.lit(1)).alias("n"))
    sinks.to_batches(totals, f"{base}/complete", f"{base}/s1", "complete")
    handle = sinks.to_batches(totals, f"{base}/update", f"{base}/s2", "update")
    expected = [("A", 2.0, 2), ("B", 1.0, 1)]
    assert rows(sinks.last_batch(spark, f"{base}/complete")) == expected
    assert rows(sinks.last_update(spark, f"{base}/update", ["sensor"]), "sensor", "total", "n") == expected
    assert sinks.progress_frame(spark, handle).agg(F.sum("input_rows")).first()[0] == 3


def test_upsert_sink_is_idempotent(spark, base, rows):
    drop_file(spark, f"{base}/in", "1", [("2024-01-01 00:00:10", "A", 1.0), ("2024-01-01 00:00:20", "B", 2.0)], 300)
    drop_file(spark, f"{base}/in", "2", [("2024-01-01 00:00:30", "A", 5.0)], 200)
    table = VersionedTable(spark, f"{base}/table", ["sensor"])
    totals = feed(spark, base).groupBy("sensor").agg(F.sum("temp").alias("total"))
    sinks.to_versioned_table(totals, table, f"{base}/state")
    expected = [("A", 6.0), ("B", 2.0)]
    assert rows(table.as_of()) == expected
    table.merge(spark.createDataFrame(expected, "sensor string, total double"))
    assert rows(table.as_of()) == expected


def test_memory_sink_is_queried_by_sql(spark, base):
    drop_file(spark, f"{base}/in", "1", [("2024-01-01 00:00:10", "A", 1.0)], 300)
    stream = feed(spark, base)
    sinks.to_memory(stream.select("sensor"), "readings", "append", f"{base}/state")
    assert stream.sparkSession.sql("SELECT count(*) AS n FROM readings").first()["n"] == 1


def test_file_stream_needs_a_schema(spark, base):
    os.makedirs(f"{base}/in")
    with pytest.raises(Exception, match="(?i)schema"):
        spark.readStream.format("csv").load(f"{base}/in")


def test_rate_feed_with_processing_time_trigger(spark, base):
    stream = rate_feed(stream_session(spark), 50)
    assert stream.isStreaming
    assert [(f.name, f.dataType.simpleString()) for f in stream.schema.fields] == [
        ("timestamp", "timestamp"),
        ("value", "bigint"),
    ]
    lag = (F.col("processing_time").cast("double") - F.col("timestamp").cast("double")) * 1000
    mapped = stream.withColumn("processing_time", F.current_timestamp()).withColumn("lag_ms", lag)
    handle = (
        mapped.writeStream.format("memory")
        .queryName("ticks")
        .option("checkpointLocation", f"{base}/state")
        .trigger(processingTime="1 second")
        .start()
    )
    session = stream.sparkSession
    try:
        assert handle.name == "ticks" and handle.id in [q.id for q in session.streams.active]
        deadline = time.time() + 40
        while time.time() < deadline and session.table("ticks").count() == 0:
            time.sleep(0.5)
        assert "message" in handle.status
        assert session.table("ticks").filter("lag_ms > -1000").count() > 0
    finally:
        assert sinks.stop_all(session) >= 1
    assert not handle.isActive


def test_continuous_trigger_on_map_only_query(spark, base):
    stream = rate_feed(stream_session(spark), 20, partitions=2)
    handle = (
        stream.select((F.col("value") * 2).alias("v"))
        .writeStream.format("memory")
        .queryName("continuous_ticks")
        .option("checkpointLocation", f"{base}/state")
        .trigger(continuous="1 second")
        .start()
    )
    try:
        time.sleep(4)
        assert handle.exception() is None
        assert handle.isActive
    finally:
        handle.stop()


def test_console_sink(spark, base):
    drop_file(spark, f"{base}/in", "1", [("2024-01-01 00:00:10", "A", 1.0)], 300)
    writer = feed(spark, base).writeStream.format("console").option("checkpointLocation", f"{base}/state")
    assert sinks.run_to_end(writer).exception() is None


def test_sensor_readings_equal_on_batch_and_stream(spark, sf, base, rows):
    events = spark.read.schema(EVENTS).parquet(f"{sf}/events.parquet")
    batch = sensor_readings(events, "event_id", "ts")
    stream = file_feed(stream_session(spark), "parquet", f"{sf}/{{events}}.parquet", EVENTS)
    sinks.to_files(sensor_readings(stream, "event_id", "ts"), f"{base}/out", f"{base}/state")
    assert rows(spark.read.parquet(f"{base}/out")) == rows(batch)
    assert batch.filter("temperature < 20 OR temperature >= 40").count() == 0


def test_streaming_sort_is_rejected_outside_complete_mode(spark, base):
    drop_file(spark, f"{base}/in", "1", [("2024-01-01 00:00:10", "A", 1.0)], 300)
    with pytest.raises(Exception, match="(?i)sort"):
        sinks.to_files(feed(spark, base).orderBy("ts"), f"{base}/out", f"{base}/state")


def test_portions_hold_every_row_once(spark):
    frame = spark.sql("SELECT id, CASE WHEN id % 5 > 0 THEN timestamp_micros(id * 1000003) END AS ts FROM range(100)")
    portions = in_event_order(frame, "ts", 4)
    ids = [[r["id"] for r in frame.filter(p).collect()] for p in portions]
    assert len(ids) == 4 and sorted(sum(ids, [])) == list(range(100))
    assert {k for k in range(0, 100, 5)} <= set(ids[0])


EVENT = "event_id long, ts timestamp, user_id long, value double"


def drop_events(spark, folder, name, data, age):
    frame = spark.createDataFrame([(k, t, u, v) for k, (t, u, v) in enumerate(data)], "event_id long, ts string, user_id long, value double")
    part = f"{folder}-{name}"
    frame.coalesce(1).write.json(part)
    os.makedirs(folder, exist_ok=True)
    source = next(f for f in os.listdir(part) if f.endswith(".json"))
    os.link(os.path.join(part, source), os.path.join(folder, f"{name}.json"))
    stamp = time.time() - age
    os.utime(os.path.join(folder, f"{name}.json"), (stamp, stamp))


def at(time_of_day):
    return f"2024-01-01 {time_of_day}:00"


def test_sessions_end_and_leave_no_state(spark, base, rows):
    from pyspark.sql.types import _parse_datatype_string

    # user 1: two spans joined by a later, earlier-timed event; user 2 stays silent and is ended by its timer;
    # user 3 is open at the end; the event without a time counts nowhere
    drop_events(spark, f"{base}/in", "1", [(at("00:00"), 1, 1.0), (at("00:20"), 1, 2.0), (at("00:05"), 2, None), (None, 2, 9.0)], 400)
    drop_events(spark, f"{base}/in", "2", [(at("00:10"), 1, 4.0), (at("00:25"), 3, 1.0)], 300)
    drop_events(spark, f"{base}/in", "3", [(at("02:00"), 1, 8.0)], 200)
    drop_events(spark, f"{base}/in", "4", [(at("02:30"), 3, 16.0), (at("02:30"), 1, 0.5)], 100)
    stream = file_feed(stream_session(spark), "json", f"{base}/in", _parse_datatype_string(EVENT), 1)
    handle = sinks.to_files(user_sessions(stream, "ts", "10 minutes", "15 minutes"), f"{base}/out", f"{base}/state")
    out = spark.read.parquet(f"{base}/out").select(
        "user_id", F.date_format(F.timestamp_micros("first_us"), "HH:mm"), F.date_format(F.timestamp_micros("last_us"), "HH:mm"), "events", "value_cents"
    )
    assert rows(out) == [(1, "00:00", "00:20", 3, 700), (1, "02:00", "02:00", 1, 800), (2, "00:05", "00:05", 1, 0), (3, "00:25", "00:25", 1, 100)]
    # the sessions of 02:30 alone are open
    assert handle.lastProgress.stateOperators[0].numRowsTotal == 2


def test_one_state_holds_the_sessions_of_many_users(spark, base, rows):
    from pyspark.sql.types import _parse_datatype_string

    rnd = random.Random(4)
    batches = [[(f"2024-01-01 {h:02d}:{rnd.randrange(60):02d}:00", rnd.randrange(60), float(rnd.randrange(9))) for _ in range(150)] for h in (0, 1, 5)]
    for age, data in zip((400, 300, 200), batches):
        drop_events(spark, f"{base}/in", str(400 - age), data, age)
    stream = file_feed(stream_session(spark), "json", f"{base}/in", _parse_datatype_string(EVENT), 1)
    handle = sinks.to_files(user_sessions(stream, "ts", "10 minutes", "2 hours", groups=3), f"{base}/out", f"{base}/state")
    found = spark.read.parquet(f"{base}/out").select("user_id", (F.col("first_us") / 60_000_000).cast("long"), (F.col("last_us") / 60_000_000).cast("long"), "events", "value_cents")
    times = {}
    for t, user, value in sum(batches, []):
        moment = datetime.datetime.fromisoformat(f"{t}+00:00")
        times.setdefault(user, []).append((int(moment.timestamp()) // 60, value))
    newest, expected = max(t for seen in times.values() for t, _ in seen), []
    for user, seen in times.items():
        sessions = []
        for t, value in sorted(seen):
            if not sessions or t - sessions[-1][1] > 10:
                sessions.append([t, t, 0, 0])
            sessions[-1] = [sessions[-1][0], t, sessions[-1][2] + 1, sessions[-1][3] + int(value * 100)]
        expected += [(user, *s) for s in sessions if s[1] + 10 < newest - 120]
    assert rows(found) == sorted(expected, key=repr)
    # the users whose sessions are open share the states of three groups
    assert handle.lastProgress.stateOperators[0].numRowsTotal <= 3


def test_spans_of_a_busy_user_collapse_in_their_task(spark):
    events = spark.range(40_000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 10).alias("ts"), F.lit(7).cast("long").alias("user_id"), F.lit(0.25).alias("value")
    )
    spans = spans_of(events, "ts", 60_000_000)
    assert spans.count() <= 2 * spark.sparkContext.defaultParallelism
    assert spans.agg(F.sum("events"), F.sum("value_cents")).first() == (40_000, 1_000_000)


@pytest.mark.parametrize("seed", range(3))
def test_chained_spans(seed):
    rnd = random.Random(seed)
    times = sorted(rnd.sample(range(1000), 60))
    spans = [(t, t, 1, 5) for t in times]
    rnd.shuffle(spans)
    expected, start = [], 0
    for k in range(1, len(times) + 1):
        if k == len(times) or times[k] - times[k - 1] > 12:
            expected.append((times[start], times[k - 1], k - start, 5 * (k - start)))
            start = k
    halves = chained(spans[:30], 12) + chained(spans[30:], 12)
    assert chained(halves, 12) == expected


def test_a_failed_batch_is_run_again_and_counts_once(spark, base, rows):
    from pyspark.errors import StreamingQueryException

    for name in "123":
        data = [(f"2024-01-01 00:0{name}:{k:02d}", f"{name}{k}", float(k)) for k in range(20)]
        drop_file(spark, f"{base}/in", name, data, 400 - 100 * int(name))
    stream = feed(spark, base).repartition(4).select("sensor", "temp")
    with pytest.raises(StreamingQueryException, match="on purpose"):
        sinks.to_rows(stream, FailingRowFiles(f"{base}/out", 1, 2), f"{base}/state")

    def written():
        return spark.read.schema("sensor string, temp double").json(f"{base}/out")

    # the first batch is there; of the second only partitions that ended before the failure
    assert written().filter("sensor LIKE '1%'").count() == 20 and written().filter("sensor LIKE '2%'").count() < 20
    sinks.to_rows(stream, RowFiles(f"{base}/out"), f"{base}/state")
    assert rows(written(), "sensor") == sorted((f"{name}{k}",) for name in "123" for k in range(20))
    assert not [f for f in os.listdir(f"{base}/out") if f.startswith("_")]


@pytest.mark.parametrize("width,slide", [(120, 30), (60, 60), (3600, 600)])
def test_windows_from_panes_equal_sliding_windows(spark, rows, width, slide):
    df = spark.range(300).select(
        F.timestamp_seconds(F.lit(-5000) + F.pmod(F.col("id") * 97, F.lit(9000))).alias("ts"),
        (F.col("id") % 3).alias("k"),
        F.when(F.col("id") % 4 > 0, F.col("id")).alias("x"),
    )
    measures = {"n": ("sum", F.lit(1)), "s": ("sum", F.col("x")), "low": ("min", F.col("x")), "high": ("max", F.col("x"))}
    plain = windowed(
        df, "ts", f"{width} seconds", ["k"],
        [F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.min("x").alias("low"), F.max("x").alias("high")], slide=f"{slide} seconds",
    )
    merged = windows_from_panes(panes(df, "ts", slide, ["k"], measures), width, slide, ["k"], {n: kind for n, (kind, _) in measures.items()})
    columns = ["window_start", "window_end", "k", "n", "s", "low", "high"]
    assert rows(merged, *columns) == rows(plain, *columns)
    text = plan_text(merged, "simple")
    assert "Expand" not in text
    with pytest.raises(ValueError):
        windows_from_panes(merged, 100, 30, ["k"], {"n": "sum"})
