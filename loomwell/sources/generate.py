"""Reproducible generated rows, spread over the cluster from the start."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Category names of seeded orders, labels of numbered rows, sensor letters.
CATEGORIES = ["Electronics", "Clothing", "Food", "Sports", "Home", "Books"]
LABELS = ["alpha", "beta", "gamma", "delta", "epsilon"]
SENSORS = ["A", "B", "C", "D"]


def pick(values: list[str], number: Column) -> Column:
    """The list's entry for a number, counted round and round."""
    entries = F.array(*[F.lit(v) for v in values])
    return F.element_at(entries, F.pmod(number, F.lit(len(values))).cast("int") + 1)


def generate_orders(customers: DataFrame, key: str, per_customer: int) -> DataFrame:
    """``per_customer`` orders for each customer row.

    Every value is arithmetic on the order id, so a re-run task gives the same
    rows again, which a random seed per partition would not.
    """
    order_no = F.col(key) * per_customer + F.col("seq")
    mixed = F.pmod(order_no * 7919, F.lit(100003))
    return (
        customers.select(F.col(key), F.explode(F.sequence(F.lit(0), F.lit(per_customer - 1))).alias("seq"))
        .select(
            F.concat(F.lit("ORD-"), order_no.cast("string")).alias("order_id"),
            F.col(key).alias("customer_id"),
            pick(CATEGORIES, mixed).alias("category"),
            (mixed % 10 + 1).cast("int").alias("quantity"),
            ((F.pmod(mixed * 31, F.lit(50000)) + 500).cast("decimal(18,2)") / 100).cast("double").alias("amount"),
            F.date_add(F.lit("2023-01-01").cast("date"), (mixed % 730).cast("int")).alias("order_date"),
        )
    )


def key_spine(df: DataFrame, key: str) -> DataFrame:
    """Every integer from 0 to the largest key, whether or not a row has it."""
    spark = df.sparkSession
    top = df.agg(F.max(key).alias("top")).first()["top"]
    return spark.range(0, (top if top is not None else -1) + 1).withColumnRenamed("id", key)
