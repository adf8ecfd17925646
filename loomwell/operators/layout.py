"""Looking at partitions, plans, schemas and the catalog; cache handling."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from contextlib import contextmanager, redirect_stdout

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def partition_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


def keys_per_partition(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys in each partition and how many partitions each key lies in."""
    spread = df.select(F.spark_partition_id().alias("partition_id"), key).distinct()
    return spread.groupBy(key).agg(F.count(F.lit(1)).alias("partitions"))


def sort_within(df: DataFrame, partitions: int, key: str, *order: str) -> DataFrame:
    """Equal keys together, each partition sorted; no global order."""
    return df.repartition(partitions, key).sortWithinPartitions(*order)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()


def exchange_count(df: DataFrame) -> int:
    """Shuffles in the plan before adaptive changes (broadcasts not counted)."""
    return len(re.findall(r"^[\s:+|-]*Exchange ", plan_text(df, "simple"), flags=re.M))


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame that several actions read, and release it afterwards."""
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist(blocking=True)


def schema_frame(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null row count of every column, in one pass."""
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.col(f.name)).alias("non_null_rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*entries).alias("c")).select(F.inline("c"))


def catalog_frame(spark: SparkSession) -> DataFrame:
    """Every table and view of the current database with its columns."""
    rows = [
        (t.name, t.tableType, c.name, c.dataType)
        for t in spark.catalog.listTables()
        for c in spark.catalog.listColumns(t.name)
    ]
    return spark.createDataFrame(rows, "table_name string, table_type string, column_name string, data_type string")


def curve_place(df: DataFrame, columns: list[str], bits: int = 10) -> Column:
    """The place of a row on a curve through the space of integer columns that keeps near points near.

    Each column's range is cut into 2^bits equal steps, and the bits of all steps are
    interleaved, the highest first. NULLs lie at the start.
    """
    if not 0 < bits * len(columns) < 63:
        raise ValueError("the interleaved bits must fit into a long")
    ends = df.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(f"e{k}") for k, c in enumerate(columns)]).first()
    place = F.lit(0).cast("long")
    for k, c in enumerate(columns):
        low, high = ends[f"e{k}"]["low"], ends[f"e{k}"]["high"]
        width = max((high or 0) - (low or 0), 1)
        step = F.coalesce(F.floor((F.col(c) - F.lit(low or 0)) * ((1 << bits) - 1) / width).cast("long"), F.lit(0).cast("long"))
        for b in range(bits):
            bit = F.shiftright(step, b).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - k))
    return place


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, group_bytes: int = 128 << 20) -> None:
    """Parquet files of about equal size along the curve through ``columns``.

    A file, and a row group in it, covers a small box of that space, so the least and
    greatest values that Parquet keeps rule most of them out for a filter on any of
    the columns, which sorting by one column achieves for that column alone.
    """
    placed = df.withColumn("_place", curve_place(df, columns))
    dealt = placed.repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place")
    dealt.write.option("parquet.block.size", group_bytes).parquet(path)


def scan_rows(df: DataFrame) -> list[int]:
    """Rows that each file scan of an executed frame has read, after skipping files and row groups."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    found, stack = [], [plan]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
        if node.metrics().contains("numFiles"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        stack += [children.apply(k) for k in range(children.size())]
    return found
