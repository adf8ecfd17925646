"""Exact row positions and running aggregates within groups of any size.

A window gives a whole group to one task, and any group may hold a large share of
the rows. So a group is cut into one range of its order per ``rows_per_task`` of its
rows, as ``salted_join`` gives a key one salt per so many rows: most groups are one
range, a hot group has many. The window works on ranges, and what the earlier ranges of
a group hold is added to the later ones. Rows of groups that are one range are dealt
once, by the window itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from math import ceil
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwell.operators.layout import persisted
from loomwell.sources.files import stored

ROWS_PER_TASK = 250_000
LEAST_ROWS_PER_TASK = 20_000  # below it a range of its own does not pay


def group_by_key(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """One row per group: the keys packed in a struct ``_key``, and the aggregates."""
    return df.groupBy(F.struct(*keys).alias("_key")).agg(*[c.alias(n) for n, c in stats.items()])


def join_by_key(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Add the columns of ``right``, which carries ``_key``, to the rows of ``left``.

    Structs that hold NULL compare as equal, as groups do. Both sides are joined on
    the struct inside another one: an aggregate grouped on ``_key`` is then
    shuffled once more, one row per key, and adaptive execution can split a hot key,
    which it does only where plain shuffles feed both sides of a join.
    """
    inner = F.struct(F.struct(*keys).alias("_key"))
    right = right.withColumn("_key", F.struct("_key"))
    return left.withColumn("_key", inner).join(right, "_key", how).drop("_key")


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on plain key columns in which NULL equals NULL."""
    rest = [c for c in right.columns if c not in keys]
    return join_by_key(left, right.select(F.struct(*keys).alias("_key"), *rest), keys, how)


# Plans of these nodes alone are cheaper to read again than to keep.
CHEAP = {"Project", "Filter", "Generate", "LogicalRelation", "LocalRelation", "Range", "InMemoryRelation", "LogicalRDD", "SubqueryAlias"}


def cheap_to_read(df: DataFrame) -> bool:
    """Whether the frame is a scan with filters, column expressions and lists to rows that give the same each time."""
    stack = [df._jdf.queryExecution().optimizedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() not in CHEAP or not node.deterministic():
            return False
        children = node.children()
        stack += [children.apply(k) for k in range(children.size())]
    return True


@contextmanager
def read_once(df: DataFrame) -> Iterator[DataFrame]:
    """The frame for several jobs in a row; unless it is cheap to read, the first one keeps it for the others."""
    if cheap_to_read(df):
        yield df
    else:
        with persisted(df) as held:
            yield held


def range_count(rows: int, rows_per_task: int, cores: int = 1) -> int:
    """Ranges of about ``rows_per_task`` rows each; few rows still use the cores there are."""
    return max(1, ceil(rows / rows_per_task), min(cores, ceil(rows / LEAST_ROWS_PER_TASK)))


@dataclass
class Ranges:
    """Rows with the number ``_range`` of their range in their group, and of them those of groups with several."""

    rows: DataFrame
    several: DataFrame | None


def in_ranges(df: DataFrame, keys: list[str], order: list[Column], rows_per_task: int) -> Ranges:
    """Cut each group into ranges of ``order``, one per ``rows_per_task`` of its rows.

    The input is worked out once: unless it is cheap to read, it is written first.
    The count that finds the groups with several ranges reads the keys alone. Only the
    rows of those groups are dealt by range, and written, so that range numbers cannot
    change between their uses, even after a lost executor.
    """
    rows = df if cheap_to_read(df) else stored(df, "rows")
    if not keys:
        several, ranges = rows, range_count(rows.count(), rows_per_task, df.sparkSession.sparkContext.defaultParallelism)
    else:
        # fewer groups than there will be ranges
        large = group_by_key(rows, keys, {"_rows": F.count(F.lit(1))}).filter(F.col("_rows") > rows_per_task)
        ranges = range_count(large.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0], rows_per_task)
    if ranges == 1:
        return Ranges(rows.withColumn("_range", F.lit(0)), None)
    if keys:
        large = stored(large.select("_key"), "large-groups")
        several = join_by_key(rows, large, keys, "left_semi")
    dealt = several.repartitionByRange(ranges, *[F.col(k) for k in keys], *order)
    several = stored(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    if not keys:
        return Ranges(several, several)
    single = join_by_key(rows, large, keys, "left_anti").withColumn("_range", F.lit(0))
    return Ranges(single.unionByName(several), several)


# How an aggregate combines over rows, and over two parts of which either may be NULL.
OVER_ROWS = {"sum": F.sum, "min": F.min, "max": F.max}
OF_TWO = {
    "sum": lambda a, b: F.when(a.isNull(), b).otherwise(a + F.coalesce(b, F.lit(0))),
    "min": F.least,
    "max": F.greatest,
}


def carried(several: DataFrame, keys: list[str], kinds: dict[str, str], back: bool) -> DataFrame:
    """Per group and range: the aggregates ``_carry_*`` over the group's ranges before (with ``back``, after) it.

    Hardly more rows than there are ranges.
    """
    sums = several.groupBy(*keys, "_range").agg(*[OVER_ROWS[k](f"_part_{n}").alias(f"_part_{n}") for n, k in kinds.items()])
    turn = F.desc("_range") if back else F.asc("_range")
    others = Window.partitionBy(*keys).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    carry = [OVER_ROWS[k](f"_part_{n}").over(others).alias(f"_carry_{n}") for n, k in kinds.items()]
    some = [F.col(f"_carry_{n}").isNotNull() for n in kinds]
    return sums.select(*keys, "_range", *carry).filter(reduce(or_, some))


def running(
    ranges: Ranges, keys: list[str], order: list[Column], parts: dict[str, tuple[str, Column]], back: bool = False
) -> DataFrame:
    """Add aggregates from the group's first row in ``order`` to the current one; ``parts`` gives kind and value.

    With ``back``, ``order`` is the reverse of the order of the ranges.
    """
    kinds = {n: kind for n, (kind, _) in parts.items()}
    values = {f"_part_{n}": c for n, (_, c) in parts.items()}
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = {n: OVER_ROWS[k](f"_part_{n}").over(inside) for n, k in kinds.items()}
    valued = ranges.rows.withColumns(values)
    if ranges.several is not None:
        carry = carried(ranges.several.withColumns(values), keys, kinds, back)
        valued = join_on_keys(valued, F.broadcast(carry), [*keys, "_range"], "left")
        found = {n: OF_TWO[k](found[n], F.col(f"_carry_{n}")) for n, k in kinds.items()}
    return valued.withColumns(found).drop("_range", *values, *[f"_carry_{n}" for n in kinds])


def with_position(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str = "position",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the 1-based row number of each row in its group; ``order`` must be total."""
    return position_by_range(df, keys, order, name, rows_per_task)


def position_by_range(
    df: DataFrame, keys: list[str], order: list[Column], name: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Row numbers from ranges of (keys, order), each in a task of its own."""
    ranges = in_ranges(df, keys, order, rows_per_task)
    return running(ranges, keys, order, {name: ("sum", F.lit(1))})


def with_running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    totals: dict[str, Column],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add cumulative sums from the first row of the group to the current one; ``order`` must be total.

    Sum decimals or integers: their sum does not depend on how rows are dealt.
    """
    ranges = in_ranges(df, keys, order, rows_per_task)
    return running(ranges, keys, order, {n: ("sum", c) for n, c in totals.items()})
