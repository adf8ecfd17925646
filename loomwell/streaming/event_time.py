"""Event-time windows; the same code serves batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.operators.ordering import OVER_ROWS
from loomwell.sources.generate import SENSORS, pick


def windowed(
    df: DataFrame,
    ts: str,
    width: str,
    keys: list[str],
    measures: list[Column],
    slide: str | None = None,
    lateness: str | None = None,
) -> DataFrame:
    """Aggregate per key and window; tumbling unless ``slide`` is given.

    ``lateness`` sets the watermark, which bounds streaming state: rows older
    than it are dropped and windows it has passed are final.
    """
    if lateness:
        df = df.withWatermark(ts, lateness)
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    rest = [k for k in keys]
    grouped = df.groupBy(window.alias("window"), *rest).agg(*measures)
    measured = [c for c in grouped.columns if c not in ("window", *rest)]
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest, *measured
    )


def panes(
    df: DataFrame, ts: str, slide: int, keys: list[str], measures: dict[str, tuple[str, Column]], lateness: str | None = None
) -> DataFrame:
    """Aggregate once per key and slide of ``slide`` seconds: the pieces that sliding windows are made of.

    ``measures`` gives each new column its kind (sum, min or max) and its value.
    """
    parts = [OVER_ROWS[kind](c).alias(n) for n, (kind, c) in measures.items()]
    return windowed(df, ts, f"{slide} seconds", keys, parts, lateness=lateness).drop("window_end")


def windows_from_panes(found: DataFrame, width: int, slide: int, keys: list[str], kinds: dict[str, str]) -> DataFrame:
    """Sliding windows of ``width`` seconds, each from its ``width / slide`` panes.

    Rows were aggregated into panes before; only panes are copied to the windows that
    they lie in, so the cost no longer grows with rows times windows.
    """
    if slide <= 0 or width % slide:
        raise ValueError("the width of a window must be a multiple of its slide")
    back = F.explode(F.transform(F.sequence(F.lit(0), F.lit(width // slide - 1)), lambda k: F.make_dt_interval(secs=k * slide)))
    placed = found.withColumn("_back", back).withColumn("window_start", F.col("window_start") - F.col("_back"))
    grouped = placed.groupBy("window_start", *keys).agg(*[OVER_ROWS[kind](n).alias(n) for n, kind in kinds.items()])
    end = F.col("window_start") + F.make_dt_interval(secs=F.lit(width))
    return grouped.select("window_start", end.alias("window_end"), *keys, *kinds)


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def sensor_readings(df: DataFrame, value: str, ts: str) -> DataFrame:
    """Shape a (timestamp, number) feed into labelled sensor rows.

    The temperature is arithmetic on the number rather than a random draw, so a
    batch that is run again produces the same reading.
    """
    return df.select(
        F.col(ts).alias("event_time"),
        F.col(value).alias("value"),
        F.concat(F.lit("sensor_"), pick(SENSORS, F.col(value))).alias("sensor_id"),
        (F.pmod(F.col(value) * 7919, F.lit(2000)) / 100 + 20).alias("temperature"),
    )
