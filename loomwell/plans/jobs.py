"""Whole jobs put together from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.functions.numbers import money, tax_on
from loomwell.functions.text import word_rows
from loomwell.operators.windows import top_n_with_ties


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each lower-case word over whole texts."""
    return (
        df.select(text)
        .select(word_rows(F.col(text)))
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """Typed, trimmed orders with tax, total and date parts; bad or non-positive rows removed.

    Input columns may all be text. ``try_`` conversions turn unreadable numbers
    and dates into NULL instead of failing the job, and the required-field
    filter runs once, after them.
    """
    amount = F.expr("try_cast(trim(amount) AS decimal(18,2))")
    day = F.expr("try_to_date(order_date, 'yyyy-MM-dd')")
    return (
        raw.withColumns(
            {
                "amount": amount,
                "category": F.upper(F.trim("category")),
                "product": F.trim("product"),
                "order_date": day,
            }
        )
        .dropna(subset=["order_id", "customer_id", "amount"])
        .filter(F.col("amount") > 0)
        .withColumn("tax", tax_on(F.col("amount")))
        .withColumn("total_amount", (F.col("amount") + F.col("tax")).cast("decimal(18,2)"))
        .withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    )


def monthly_summary(clean: DataFrame) -> DataFrame:
    """Orders, revenue and mean order value per category and month."""
    return clean.groupBy("category", "year", "month").agg(
        F.count("order_id").alias("order_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.round(F.sum("amount") / F.count("amount"), 2).alias("avg_order_value"),
    )


def orders_as_raw(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The order table in the text layout the cleaning job expects."""
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("product"),
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("category"),
        money("o_totalprice").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    )


def best_orders_per_group(
    orders: DataFrame, customers: DataFrame, minimum: Column, group: str, n: int
) -> DataFrame:
    """Large orders, joined to customers, the first n ranks per group, then group statistics."""
    kept = orders.filter(F.col("o_totalprice") >= minimum)
    joined = kept.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(group, "o_orderkey", "o_totalprice")
    ranked = top_n_with_ties(joined, [group], "o_totalprice", n)
    return ranked.groupBy(group).agg(
        F.count(F.lit(1)).alias("top_orders"),
        F.sum(money("o_totalprice")).cast("double").alias("top_total"),
        F.max("o_totalprice").alias("largest"),
    )
