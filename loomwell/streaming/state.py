"""Own keyed state across micro-batches: running totals that stay, and sessions that end."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from math import ceil
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomwell.operators.ordering import ROWS_PER_TASK

# Send these functions themselves to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "user_id long, part int, event_count long, value_cents long, largest_cents long"
STATE = "event_count long, value_cents long, largest_cents long"


def _accumulate(
    key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    count, total, largest = state.get if state.exists else (0, None, None)
    for pdf in frames:
        count += len(pdf)
        seen = pdf["value_cents"].dropna()
        if len(seen):
            total = (total or 0) + int(seen.sum())
            largest = int(seen.max()) if largest is None else max(largest, int(seen.max()))
    state.update((count, total, largest))
    yield pd.DataFrame(
        {
            "user_id": [key[0]],
            "part": [key[1]],
            "event_count": [count],
            "value_cents": pd.array([total], dtype="Int64"),
            "largest_cents": pd.array([largest], dtype="Int64"),
        }
    )


def running_user_totals(events: DataFrame, parts: int) -> DataFrame:
    """Count, sum and maximum per user kept in state and emitted when they change.

    The state of a user is held in ``parts`` pieces chosen by event id, so one
    very busy user still spreads over that many tasks (``parts_for`` derives the
    number from rows seen before); ``merge_parts`` adds the pieces up. NULL values
    count as events only; a user without a value has a NULL sum and maximum.
    """
    keyed = events.select(
        "user_id",
        F.pmod("event_id", F.lit(parts)).cast("int").alias("part"),
        F.round(F.col("value") * 100).cast("long").alias("value_cents"),
    )
    return keyed.groupBy("user_id", "part").applyInPandasWithState(
        _accumulate, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout
    )


def parts_for(events: DataFrame, rows_per_part: int = ROWS_PER_TASK) -> int:
    """Pieces for the busiest user of the events seen so far."""
    busiest = events.groupBy("user_id").count().agg(F.max("count")).first()[0]
    return max(1, ceil((busiest or 0) / rows_per_part))


def merge_parts(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("user_id").agg(
        F.sum("event_count").alias("event_count"),
        F.sum("value_cents").alias("value_cents"),
        F.max("largest_cents").alias("largest_cents"),
    )


# ---- sessions ---------------------------------------------------------------

SPAN = "user_id long, first_us long, last_us long, events long, value_cents long, at timestamp"
SESSION = "user_id long, first_us long, last_us long, events long, value_cents long"
OPEN = "users array<long>, firsts array<long>, lasts array<long>, events array<long>, cents array<long>"
COLUMNS = ["user_id", "first_us", "last_us", "events", "value_cents"]

# A call for one group costs milliseconds whatever it holds, so a group has many users; a core gets several groups.
USERS_PER_GROUP = 500
GROUPS_PER_CORE = 16
# Rows that are sorted and merged at once.
CHUNK_ROWS = 100_000

Span = tuple[int, int, int, int]  # first and last microsecond, events, cents


def chained_spans(spans: pd.DataFrame, gap_us: int) -> pd.DataFrame:
    """Spans of one user that lie at most a gap apart become one, for all users at once."""
    if not len(spans):
        return spans[COLUMNS]
    ordered = spans.sort_values(["user_id", "first_us"], kind="stable")
    user, first, last, events, cents = (ordered[c].to_numpy() for c in COLUMNS)
    reach = ordered.groupby("user_id")["last_us"].cummax().to_numpy()
    fresh = np.ones(len(ordered), dtype=bool)
    fresh[1:] = (user[1:] != user[:-1]) | (first[1:] - reach[:-1] > gap_us)
    starts = np.flatnonzero(fresh)
    merged = [user[starts], first[starts], np.maximum.reduceat(last, starts), np.add.reduceat(events, starts), np.add.reduceat(cents, starts)]
    return pd.DataFrame(dict(zip(COLUMNS, merged)))


def chained(spans: list[Span], gap_us: int) -> list[Span]:
    """The same for the spans of one user."""
    frame = pd.DataFrame([(0, *s) for s in spans], columns=COLUMNS)
    return list(chained_spans(frame, gap_us)[COLUMNS[1:]].itertuples(index=False, name=None))


def in_chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of the frames in fewer frames, of at least CHUNK_ROWS rows but for the last."""
    held: list[pd.DataFrame] = []
    for pdf in frames:
        if len(pdf):
            held.append(pdf)
        if sum(map(len, held)) >= CHUNK_ROWS:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def spans_of(events: DataFrame, ts: str, gap_us: int) -> DataFrame:
    """Events of one user that a task holds together and that lie at most a gap apart, as one row.

    It keeps no state. A very busy user sends few rows to the task that holds the
    user's sessions, however many events there are. Events without a time belong to
    no session; a missing value adds nothing.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in in_chunks(frames):
            spans = chained_spans(pdf, gap_us)
            yield spans.assign(at=pd.to_datetime(spans["last_us"], unit="us", utc=True))

    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    listed = events.filter(F.col(ts).isNotNull() & F.col("user_id").isNotNull()).select(
        "user_id",
        micros.alias("first_us"),
        micros.alias("last_us"),
        F.lit(1).cast("long").alias("events"),
        F.coalesce(F.round(F.col("value") * 100).cast("long"), F.lit(0)).alias("value_cents"),
    )
    return listed.mapInPandas(run, SPAN)


def groups_for(events: DataFrame) -> int:
    """Groups of users for the users of the events seen so far."""
    users = events.agg(F.approx_count_distinct("user_id")).first()[0]
    return max(GROUPS_PER_CORE * events.sparkSession.sparkContext.defaultParallelism, ceil(users / USERS_PER_GROUP))


def user_sessions(events: DataFrame, ts: str, gap: str, lateness: str, groups: int = 1024) -> DataFrame:
    """Sessions of a stream: events of a user that follow each other within ``gap``; append mode.

    A session is emitted once the watermark, ``lateness`` behind the newest event,
    has passed its last event by more than the gap: no event that still counts can
    then extend it. Users are dealt to ``groups`` by a hash (``groups_for`` derives the
    number from rows seen before), and a group holds the open sessions of its users. An
    event-time timer wakes the group whose next session ends even if no event comes,
    and a group without an open session holds no state. Events may come in any order
    within the lateness, so a user can have several open sessions.
    """
    gap_us = int(pd.Timedelta(gap) / pd.Timedelta(microseconds=1))

    def close(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame(dict(zip(COLUMNS, state.get if state.exists else [[]] * len(COLUMNS))), dtype="int64")
        for pdf in in_chunks(frames):
            held = chained_spans(pd.concat([held, pdf[COLUMNS]], ignore_index=True), gap_us)
        over = held["last_us"] + gap_us < state.getCurrentWatermarkMs() * 1000
        ended, still = held[over], held[~over]
        if len(still):
            state.update(tuple(still[c].tolist() for c in COLUMNS))
            state.setTimeoutTimestamp((int(still["last_us"].min()) + gap_us) // 1000)
        elif state.exists:
            state.remove()
        if len(ended):
            yield ended

    spans = spans_of(events, ts, gap_us).withWatermark("at", lateness)
    grouped = spans.withColumn("group", F.pmod(F.xxhash64("user_id"), F.lit(groups)))
    return grouped.groupBy("group").applyInPandasWithState(
        close, SESSION, OPEN, "append", GroupStateTimeout.EventTimeTimeout
    )
