"""Joins with checked broadcasts, and joins on skewed keys."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.operators.ordering import ROWS_PER_TASK

# Bytes as stored; decoded rows take several times as much on every executor.
BROADCAST_LIMIT = 16 * 1024 * 1024
NULL_SALTS = 1024
SALTABLE = {"inner", "left", "left_semi", "left_anti"}


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate for a plan (file sizes, scaled to the columns read)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only while the size estimate stays below ``max_bytes``."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def filter_by_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str, anti: bool = False) -> DataFrame:
    """Semi join (or anti join): left rows with (without) a match on the right.

    The right keys are made distinct first, with map-side combine, so a key repeated
    in a large share of the right rows does not land in one task. Both sides are
    joined on the key inside a struct: that shuffles the distinct keys once more, and
    adaptive execution can then split a hot key of the left rows. NULL matches nothing.
    """
    matches = right.select(F.col(right_key).alias("_match")).dropna().distinct()
    same = F.struct(F.col(left_key).alias("k")) == F.struct(F.col("_match").alias("k"))
    return left.join(matches, same, "left_anti" if anti else "left_semi")


def cross_with_values(df: DataFrame, name: str, values: list) -> DataFrame:
    """Cross product of a table with a short list written in the query.

    The list is part of the plan, so the output is ``len(values)`` times the
    input. A product of two tables grows with the square of the data and is not
    offered.
    """
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def product_of_small(left: DataFrame, right: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Every left row with every right row, of two tables that both have at most ``max_rows`` rows.

    The sizes are counted, not estimated, up to one row more than allowed, and a
    larger table is refused: a product grows with the square of the data.
    """
    for side in (left, right):
        if side.limit(max_rows + 1).count() > max_rows:
            raise ValueError(f"a product takes tables of at most {max_rows} rows")
    return left.crossJoin(F.broadcast(right))


def runtime_filter_session(spark: SparkSession, least_scan_bytes: int = 0) -> SparkSession:
    """A session whose shuffle joins filter their large side at the scan.

    Spark builds a Bloom filter of the join keys that are left on the side that is
    filtered, and tests the other side's rows against it before they are shuffled,
    wherever that side reads at least ``least_scan_bytes``. The filter has a bounded
    number of bits; rows that pass by chance are dropped by the join.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    session.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", True)
    session.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", least_scan_bytes)
    return session


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    row_key: list[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join in which a key gets one salt per ``rows_per_task`` of its left rows.

    Left rows take one of their key's salts, and only the right rows of keys with
    several are copied. Keys with several hold more than ``rows_per_task`` rows
    each, so they are few against the rows, whatever the table size; their list
    stays a table, which Spark broadcasts only if it is small. Right and full outer
    joins are refused: an unmatched right row would come out once per copy.
    """
    if how not in SALTABLE:
        raise ValueError(f"salted join supports {sorted(SALTABLE)}, not {how}")
    salts = key_salts(left, on, rows_per_task)
    # NULL keys match nothing, so they are spread without any copies
    missing = reduce(or_, [F.col(k).isNull() for k in on])
    count = F.when(missing, F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = left.join(salts, on, "left").withColumn("_salt", F.pmod(row_hash(left, row_key), count).cast("int"))
    copies = right.join(salts, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return salted.drop("_salts").join(copies.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def row_hash(df: DataFrame, row_key: list[str] | None = None) -> Column:
    """A number that depends only on the row, so a re-run task repeats it."""
    return F.xxhash64(*(row_key or df.columns))


def key_salts(df: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and ``_salts``, the tasks their rows fill."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows_per_task)
    return counts.select(*on, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_salts"))


def key_skew(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key with the key's share of the table and its ratio to the mean key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    table = counts.agg(
        F.struct(F.sum("rows").alias("total"), F.count(F.lit(1)).alias("keys")).alias("t")
    ).scalar()
    return counts.select(
        *keys,
        "rows",
        (F.col("rows") / table["total"]).alias("share"),
        (F.col("rows") * table["keys"] / table["total"]).alias("ratio_to_mean"),
    )
