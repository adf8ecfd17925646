"""De-duplication, replication and appending."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.operators.windows import top_n_per_group


def deduplicate(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first under a total order, so the survivor is always the same."""
    return top_n_per_group(df, keys, order, 1, name="_rn").drop("_rn")


def replicate(df: DataFrame, n: int, name: str = "copy") -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def append_all(*batches: DataFrame) -> DataFrame:
    """All rows of all batches, matched by column name; absent columns read as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
