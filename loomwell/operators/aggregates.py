"""Profiles, exact quantiles and whole-group lists that do not need one big task."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from itertools import combinations
from math import ceil, copysign, floor, inf, isinf, nan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwell.operators.ordering import (
    ROWS_PER_TASK,
    join_by_key,
    join_on_keys,
    read_once,
    with_position,
    with_running_totals,
)


def collect_in_chunks(
    df: DataFrame,
    keys: list[str],
    value: str,
    row_key: str,
    chunk_rows: int,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All values of each group in sorted order, as numbered arrays of ``chunk_rows`` values.

    A group's full list can exceed what one row may hold. The chunks of a group,
    in order, are that list; a group within ``chunk_rows`` has a single one.
    ``row_key`` is unique and orders equal values, so that many copies of one
    value still spread over tasks.
    """
    columns = dict.fromkeys([*keys, value, row_key])
    in_order = [F.col(value), F.col(row_key)]
    placed = with_position(df.select(*columns), keys, in_order, "_pos", rows_per_task)
    chunk = F.floor((F.col("_pos") - 1) / chunk_rows).cast("int").alias("chunk")
    return placed.groupBy(*keys, chunk).agg(F.array_sort(F.collect_list(value)).alias("values"))


def collect_set_in_chunks(
    df: DataFrame, keys: list[str], value: str, chunk_rows: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Distinct values of each group, de-duplicated on the map side before they travel."""
    return collect_in_chunks(df.select(*keys, value).distinct(), keys, value, value, chunk_rows, rows_per_task)


def levels_of(keys: list[str], how: str) -> list[list[str]]:
    """The groupings of a rollup (shrinking prefixes) or a cube (all subsets)."""
    if how == "rollup":
        return [keys[:n] for n in range(len(keys), -1, -1)]
    if how == "cube":
        return [list(c) for n in range(len(keys), -1, -1) for c in combinations(keys, n)]
    raise ValueError(f"subtotals are by rollup or cube, not {how}")


def with_dense_code(df: DataFrame, value: str, name: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Number the distinct values of a column from 1 on, in their order; a NULL has no number."""
    values = df.select(value).filter(F.col(value).isNotNull()).distinct()
    return join_on_keys(df, with_position(values, [], [F.asc(value)], name, rows_per_task), [value], "left")


def distinct_by_level(
    df: DataFrame, keys: list[str], value: str, how: str = "rollup", name: str = "distinct_values"
) -> DataFrame:
    """Exact distinct counts of an integer column at every level of a rollup or cube.

    A distinct count cannot be added up, so Spark copies every input row once per
    level. Bitmaps can be merged: the input is reduced to one bitmap per group and
    block of 32768 values (4 KB), map-side first, and only these are copied to the
    levels above and merged there by block. No task holds more than one block of a
    group, whatever the group. It suits columns whose values lie dense, such as keys
    of a dimension; code others by ``with_dense_code`` first.

    ``level`` is Spark's grouping id: bit k, from the right, is set where the key that
    many places from the last is a subtotal. NULLs are not counted; a group of NULLs
    alone has the count 0; NULL keys are groups.
    """
    blocks = df.groupBy(*keys, F.bitmap_bucket_number(value).alias("_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("_bits")
    )
    # the block is never summed over, so its own bit in the grouping id, the last, is always 0
    sets = [[*map(F.col, level), F.col("_block")] for level in levels_of(keys, how)]
    merged = blocks.groupingSets(sets, *keys, "_block").agg(
        F.bitmap_or_agg("_bits").alias("_bits"), F.shiftright(F.grouping_id(), 1).alias("level")
    )
    return merged.groupBy(*keys, "level").agg(F.sum(F.bitmap_count("_bits")).alias(name))


BINS = 4096  # per narrowed interval and round
ROOT = 1 / 64


@dataclass
class Sought:
    """One wanted place of a column's sorted values, and the interval that is known to hold it."""

    column: int
    rank: int  # 0-based, within the interval
    low: float
    high: float

    @property
    def found(self) -> bool:
        return not self.low < self.high


def _root(x: float) -> float:
    return copysign(abs(x) ** ROOT, x)


def _entry(i: int, c: str, low: float, high: float, bins: int, rooted: bool) -> str:
    """SQL for the interval, bin and value of a column: bins of equal width, or equally wide in a high root of the values."""
    v = c
    if rooted and _root(low) < _root(high):
        low, high, v = _root(low), _root(high), f"signum({c}) * power(abs({c}), {ROOT}D)"
    # the width of an interval may exceed the largest double
    scale = 0.5 if isinf(high - low) else 1.0
    share = f"(({v}) * {scale}D - {low * scale!r}D) / {high * scale - low * scale!r}D"
    place = f"int(greatest(least(floor({share} * {bins}), {bins - 1}), 0))"
    return f"named_struct('i', {i}, 'bin', {place}, 'v', {c})"


def _narrowed(values: DataFrame, columns: list[str], sought: list[Sought], bins: int, rooted: bool) -> None:
    """Shrink the intervals of all wanted places in one scan.

    Every interval is cut into ``bins``. The rows inside are counted by bin on the
    map side, with the least and greatest value of each bin; the bin that holds a
    wanted rank gives its next interval. The least and the greatest value of an
    interval do not share a bin of equal width, so each such round narrows it.
    """
    intervals = list(dict.fromkeys((s.column, s.low, s.high) for s in sought))
    # intervals of one column are bins of others, so a value lies in one of them at most
    entries = []
    for k, c in enumerate(columns):
        cases = [
            f"WHEN {c} BETWEEN {low!r}D AND {high!r}D THEN {_entry(n, c, low, high, bins, rooted)}"
            for n, (column, low, high) in enumerate(intervals)
            if column == k
        ]
        if cases:
            entries.append(f"CASE {' '.join(cases)} END")
    listed = values.select(F.expr(f"explode(array({', '.join(entries)})) AS e")).filter("e IS NOT NULL")
    counted = listed.groupBy("e.i", "e.bin").agg(F.expr("count(*) AS n"), F.expr("min(e.v) AS low"), F.expr("max(e.v) AS high"))
    # at most ``bins`` rows per interval from here on
    ranks: dict[int, list[str]] = {}
    for k, s in enumerate(sought):
        ranks.setdefault(intervals.index((s.column, s.low, s.high)), []).append(f"named_struct('k', {k}, 'rank', {s.rank}L)")
    wanted = " ".join(f"WHEN {i} THEN array({', '.join(r)})" for i, r in ranks.items())
    through = counted.selectExpr("*", "sum(n) OVER (PARTITION BY i ORDER BY bin) AS through")
    hits = through.selectExpr("low", "high", "through - n AS before", "through", f"inline(CASE i {wanted} END)")
    for row in hits.filter("before <= rank AND rank < through").collect():
        s = sought[row["k"]]
        s.rank, s.low, s.high = row["rank"] - row["before"], row["low"], row["high"]


def _ends(c: str) -> str:
    most = sys.float_info.max
    finite = f"CASE WHEN {c} BETWEEN {-most!r}D AND {most!r}D THEN {c} END"
    infinite = "double('infinity')"
    return (
        f"named_struct('n', count({c}), 'below', count_if({c} = -{infinite}), 'finite', count({finite}),"
        f" 'above', count_if({c} = {infinite}), 'low', min({finite}), 'high', max({finite}))"
    )


def select_quantiles(df: DataFrame, columns: list[str], shares: dict[str, float], bins: int = BINS) -> DataFrame:
    """One row per column with its interpolated quantiles, exact over all rows.

    No values are sorted and none travel: all wanted places of all columns are
    narrowed together by scans that send at most ``bins`` counters per place and task.
    A few scans do, as each divides the intervals by up to ``bins``. Values are taken as
    doubles, NULLs are left out, NaN counts as the largest value, and a column without
    a value has NULL quantiles. The input is worked out once.
    """
    if bins < 2:
        raise ValueError("an interval needs two bins to shrink")
    names = [f"c{k}" for k in range(len(columns))]
    doubles = df.select(*[(F.col(c).cast("double") + F.lit(0.0)).alias(n) for c, n in zip(columns, names)])
    with read_once(doubles) as values:
        ends = values.agg(F.expr(f"array({', '.join(map(_ends, names))}) AS ends")).first()["ends"]
        places: dict[tuple[int, int], Sought] = {}
        for k, e in enumerate(ends):
            for share in shares.values() if e["n"] else ():
                for rank in (floor(share * (e["n"] - 1)), ceil(share * (e["n"] - 1))):
                    # in sorted order: minus infinity, finite numbers, infinity, NaN
                    if e["below"] <= rank < e["below"] + e["finite"]:
                        places[k, rank] = Sought(k, rank - e["below"], e["low"], e["high"])
                    else:
                        value = -inf if rank < e["below"] else inf if rank < e["below"] + e["finite"] + e["above"] else nan
                        places[k, rank] = Sought(k, rank, value, value)
        # values spread over many orders of magnitude share few bins of equal width, so roots take turns
        rooted = False
        while open_places := [s for s in places.values() if not s.found]:
            _narrowed(values, names, open_places, bins, rooted)
            rooted = not rooted

    def at(k: int, share: float) -> float | None:
        rows = ends[k]["n"]
        if not rows:
            return None
        place = share * (rows - 1)
        low, high = places[k, floor(place)].low, places[k, ceil(place)].low
        return low if low == high else (ceil(place) - place) * low + (place - floor(place)) * high

    fields = [T.StructField("column_name", T.StringType()), *[T.StructField(n, T.DoubleType()) for n in shares]]
    found = [(c, *[at(k, share) for share in shares.values()]) for k, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(found, T.StructType(fields))


def exact_quantiles(df: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """One row of interpolated quantiles of one column."""
    return select_quantiles(df, [column], shares).drop("column_name")


def quantiles_by_group(
    df: DataFrame, keys: list[str], column: str, shares: dict[str, float], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """One row of interpolated quantiles per group, for any number of groups of any size.

    Spark's exact percentile keeps every distinct value of a group in the memory of
    one task. Here equal values are counted, the counts are added up in value order,
    and each wanted place is looked up. NULL keys are a group; NULL values are left
    out, and a group without a value has NULL quantiles.
    """
    values = df.select(*keys, F.col(column).cast("double").alias("_value"))
    counts = values.groupBy(*keys, "_value").agg(F.count("_value").alias("_n"))
    placed = with_running_totals(counts, keys, [F.asc("_value")], {"_through": F.col("_n")}, rows_per_task)
    sizes = counts.groupBy(F.struct(*keys).alias("_key")).agg((F.sum("_n") - 1).alias("_last"))
    sized = join_by_key(placed, sizes, keys)

    def at(share: float) -> Column:
        place = F.col("_last") * share

        def value_at(rank: Column) -> Column:
            return F.min(F.when((F.col("_n") > 0) & (F.col("_through") > rank), F.col("_value")))

        low, high = value_at(F.floor(place)), value_at(F.ceil(place))
        above = F.max(place - F.floor(place))
        return F.when(low == high, low).otherwise(F.max(F.ceil(place) - place) * low + above * high)

    return sized.groupBy(*keys).agg(*[at(p).alias(n) for n, p in shares.items()])


def _measures(c: str, *extra: Column) -> Column:
    return F.struct(
        F.lit(c).alias("column_name"),
        F.count(c).alias("n"),
        F.count_if(F.col(c).isNull()).alias("n_null"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
        *extra,
    )


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per numeric column: count, nulls, mean, sample deviation, min, max.

    All columns are measured in a single pass and then unpivoted.
    """
    return df.agg(F.array(*[_measures(c) for c in columns]).alias("m")).select(F.inline("m"))


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def summarise(df: DataFrame, columns: list[str]) -> DataFrame:
    """``profile`` plus exact quartiles."""
    return profile(df, columns).join(F.broadcast(select_quantiles(df, columns, QUARTILES)), "column_name")


def profile_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per text column: count, nulls, least and greatest value, and the mean of what reads as a number."""
    measures = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
            F.avg(F.col(c).try_cast("double")).alias("mean"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))
