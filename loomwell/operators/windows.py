"""Ranking, neighbour, rolling and value-range windows that survive very large groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loomwell.operators.ordering import (
    OF_TWO,
    OVER_ROWS,
    ROWS_PER_TASK,
    group_by_key,
    in_ranges,
    join_by_key,
    join_on_keys,
    position_by_range,
    running,
    with_position,
    with_running_totals,
)
from loomwell.sources.files import stored


def top_n_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "row_num"
) -> DataFrame:
    """First ``n`` rows of each group under a total order.

    Spark cuts each map task's groups to n rows before the shuffle, so no task
    receives a whole hot group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def top_n_with_ties(
    df: DataFrame, keys: list[str], by: str, n: int, descending: bool = True, name: str = "rnk"
) -> DataFrame:
    """Rows whose rank on ``by`` is at most ``n``, with every row that ties.

    The n best values of each group are found first, cut in the map tasks; they
    fix the rank of every row that qualifies. Joining them back finds the ties
    where they lie, so copies of one row are never gathered in one task.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()
    best = top_n_per_group(df.select(*keys, by), keys, [order], n, "_n")
    ranked = best.select(*keys, by, F.rank().over(Window.partitionBy(*keys).orderBy(order)).alias(name)).distinct()
    return join_on_keys(df, ranked, [*keys, by])


def with_ranks(
    df: DataFrame,
    keys: list[str],
    by: str,
    descending: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
    percent: bool = True,
) -> DataFrame:
    """Add ``rank``, ``dense_rank`` and, unless told not to, ``percent_rank`` on one column, ties sharing a rank."""
    order = F.col(by).desc() if descending else F.col(by).asc()
    # Ties collapse in the count, so even a value shared by most rows is one row here.
    counts = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    placed = with_running_totals(
        counts, keys, [order], {"_through": F.col("_n"), "dense_rank": F.lit(1)}, rows_per_task
    )
    rank = F.col("_through") - F.col("_n") + 1
    added = {"rank": rank.cast("int"), "dense_rank": F.col("dense_rank").cast("int")}
    if percent:
        placed = with_group_stats(placed, keys, {"_size": F.sum("_n")})
        added["percent_rank"] = F.when(F.col("_size") > 1, (rank - 1).cast("double") / (F.col("_size") - 1)).otherwise(0.0)
    ranks = placed.select(*keys, by, *[c.alias(n) for n, c in added.items()])
    return join_on_keys(df, ranks, [*keys, by])


def with_ntile(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    tiles: dict[str, int],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add one tile number per entry of ``tiles``; the first tiles get the spare rows."""

    def tile(n: int) -> Column:
        zero_based = F.col("_pos") - 1
        small = F.floor(F.col("_size") / n)
        spare = F.col("_size") % n
        in_large = zero_based < spare * (small + 1)
        return (
            F.when(in_large, F.floor(zero_based / (small + 1)))
            .otherwise(spare + F.floor((zero_based - spare * (small + 1)) / F.greatest(small, F.lit(1))))
            .cast("int")
            + 1
        )

    placed = position_by_range(df, keys, order, "_pos", rows_per_task)
    sized = with_group_stats(placed, keys, {"_size": F.count(F.lit(1))})
    return sized.withColumns({name: tile(n) for name, n in tiles.items()}).drop("_pos", "_size")


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    build: Callable[[WindowSpec], dict[str, Column]],
    before: int,
    after: int,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Windows that look at most ``before`` rows back and ``after`` rows ahead.

    ``build`` receives the ordered window and returns the new columns: lag, lead
    or row frames within those bounds. A group is cut into blocks of
    ``rows_per_task`` positions, and rows near a block edge are copied into the
    neighbouring block so that every frame is complete.
    """
    zero_based = F.col("_pos") - 1
    home = F.floor(zero_based / rows_per_task)
    first_user = F.floor(F.greatest(zero_based - after, F.lit(0)) / rows_per_task)
    last_user = F.floor((zero_based + before) / rows_per_task)
    return (
        position_by_range(df, keys, order, "_pos", rows_per_task)
        .withColumn("_block", F.explode(F.sequence(first_user, last_user)))
        .withColumns(build(Window.partitionBy(*keys, "_block").orderBy("_pos")))
        .filter(F.col("_block") == home)
        .drop("_pos", "_block")
    )


def with_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """Add whole-group aggregates to every row.

    An unordered window would gather each group in one task. Aggregating first
    combines on the map side; both sides of the join back are plain shuffles, the
    aggregate's with one row per key, so adaptive execution splits a hot key (or
    broadcasts the aggregate when its measured size allows).
    """
    if not keys:
        totals = df.agg(F.struct(*[c.alias(n) for n, c in stats.items()]).alias("_t")).scalar()
        return df.withColumns({n: totals[n] for n in stats})
    return join_by_key(df, group_by_key(df, keys, stats), keys)


def with_zscore(df: DataFrame, keys: list[str], value: str, name: str, digits: int = 3) -> DataFrame:
    """(x - mean) / sample deviation in each group; NULL where the deviation is 0 or undefined."""
    stats = {"_mean": F.avg(value), "_sd": F.stddev_samp(value)}
    z = (F.col(value) - F.col("_mean")) / F.col("_sd")
    return (
        with_group_stats(df, keys, stats)
        .withColumn(name, F.when(F.col("_sd") > 0, F.round(z, digits)))
        .drop("_mean", "_sd")
    )


def with_range_frames(
    df: DataFrame,
    keys: list[str],
    at: str,
    width: int,
    measures: dict[str, tuple[str, Column]],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Sums and extremes over rows whose integer ``at`` lies in [current - width, current], peers included.

    ``measures`` gives each new column its kind (sum, min or max) and its value. A
    sliding frame would be worked out again for every row. Instead the values of
    ``at`` are cut into blocks ``width`` wide. A frame that ends in a block begins in
    the one before it: it is the running aggregate of its own block up to the current
    value, and the running aggregate of the block before it, taken from its end back
    to the frame's lower bound. A probe at that bound reads the second one, so every
    distinct value adds two points to the ordered stream, and the cost is linear.

    Rows with equal keys and ``at`` collapse before they travel. As in Spark's
    frame, rows with a NULL ``at`` see each other only, and a frame without a value
    has a NULL result. Sums must be of decimals or integers.
    """
    if width < 0:
        raise ValueError("the width must not be negative")
    kinds = {n: kind for n, (kind, _) in measures.items()}
    point = df.groupBy(*keys, at).agg(*[OVER_ROWS[k](c).alias(f"_v_{n}") for n, (k, c) in measures.items()])
    # read several times below, worked out once
    point = stored(point.withColumnRenamed(at, "_at"), "points")
    found = {n: F.col(f"_v_{n}") for n in kinds}
    if width:
        with_frames = point.filter(F.col("_at").isNotNull())
        block = F.col("_at") - F.pmod("_at", F.lit(width))
        none = [F.lit(None).cast(with_frames.schema[f"_v_{n}"].dataType).alias(f"_v_{n}") for n in kinds]
        own = F.struct(block.alias("_block"), F.col("_at").alias("_place"), F.lit(1).alias("_step"), *found.values())
        # the probe stands before the rows at the lower bound, which belong to the frame
        probe = F.struct((block - width).alias("_block"), (F.col("_at") - width).alias("_place"), F.lit(0).alias("_step"), *none)
        stream = with_frames.select(*keys, F.inline(F.array(own, probe)))
        group = [*keys, "_block"]
        ranges = in_ranges(stream, group, [F.asc("_place"), F.asc("_step")], rows_per_task)
        up = {f"_up_{n}": (k, found[n]) for n, k in kinds.items()}
        down = {f"_down_{n}": (k, found[n]) for n, k in kinds.items()}
        ends = running(ranges, group, [F.asc("_place"), F.asc("_step")], up)
        starts = running(ranges, group, [F.desc("_place"), F.desc("_step")], down, back=True)
        upper = ends.filter("_step = 1").select(*keys, F.col("_place").alias("_at"), *up)
        lower = starts.filter("_step = 0").select(*keys, (F.col("_place") + width).alias("_at"), *down)
        both = join_on_keys(upper, lower, [*keys, "_at"])
        framed = both.select(*keys, "_at", *[OF_TWO[k](F.col(f"_up_{n}"), F.col(f"_down_{n}")).alias(n) for n, k in kinds.items()])
        alone = point.filter(F.col("_at").isNull()).select(*keys, "_at", *[c.alias(n) for n, c in found.items()])
        result = framed.unionByName(alone)
    else:
        result = point.select(*keys, "_at", *[c.alias(n) for n, c in found.items()])
    return join_on_keys(df, result.withColumnRenamed("_at", at), [*keys, at])


def with_range_totals(
    df: DataFrame, keys: list[str], at: str, width: int, totals: dict[str, Column], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Sums over rows whose ``at`` lies in [current - width, current], peers included."""
    return with_range_frames(df, keys, at, width, {n: ("sum", c) for n, c in totals.items()}, rows_per_task)


def with_range_extremes(
    df: DataFrame,
    keys: list[str],
    at: str,
    width: int,
    least: dict[str, Column],
    greatest: dict[str, Column],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Least and greatest values over rows whose ``at`` lies in [current - width, current], peers included."""
    measures = {n: ("min", c) for n, c in least.items()} | {n: ("max", c) for n, c in greatest.items()}
    return with_range_frames(df, keys, at, width, measures, rows_per_task)


def with_peer_totals(
    df: DataFrame, keys: list[str], by: str, totals: dict[str, Column], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Cumulative sums under the default ordered frame: rows equal in ``by`` share one value."""
    sums = [F.sum(c).alias(f"_v_{n}") for n, c in totals.items()]
    per_value = df.groupBy(*keys, by).agg(*sums)
    added = {n: F.col(f"_v_{n}") for n in totals}
    summed = with_running_totals(per_value, keys, [F.col(by)], added, rows_per_task)
    return join_on_keys(df, summed.select(*keys, by, *totals), [*keys, by])


__all__ = [
    "top_n_per_group",
    "top_n_with_ties",
    "with_group_stats",
    "with_neighbours",
    "with_ntile",
    "with_peer_totals",
    "with_position",
    "with_range_extremes",
    "with_range_frames",
    "with_range_totals",
    "with_ranks",
    "with_running_totals",
    "with_zscore",
]
