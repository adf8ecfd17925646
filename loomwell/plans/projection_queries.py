"""Projections, filters, null handling and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money, price_tier, salary_band
from loomwell.operators.reshape import deduplicate
from loomwell.plans.registry import query
from loomwell.sources.tables import load


@query("proj_select", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def proj_select(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query(
    "proj_exprs",
    """
    SELECT o_orderkey, 'order-' || CAST(o_orderkey AS varchar) AS label, lower(o_orderpriority) AS priority,
           o_totalprice > 250000 AS is_large, CAST(o_orderdate AS date) AS order_day
    FROM orders
    """,
)
def proj_exprs(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select(
        "o_orderkey",
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("label"),
        F.lower("o_orderpriority").alias("priority"),
        (F.col("o_totalprice") > 250000).alias("is_large"),
        F.to_date("o_orderdate").alias("order_day"),
    )


@query(
    "proj_with_column",
    """
    SELECT c_custkey, c_name, c_nationkey, abs(c_acctbal) AS c_acctbal, c_mktsegment, c_acctbal < 0 AS in_debt
    FROM customer
    """,
)
def proj_with_column(spark: SparkSession, d: str) -> DataFrame:
    customers = load(spark, d, "customer")
    return customers.withColumns({"in_debt": F.col("c_acctbal") < 0, "c_acctbal": F.abs("c_acctbal")})


@query("proj_literal", "SELECT s_suppkey, 'EUR' AS currency, 1 AS active FROM supplier")
def proj_literal(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "supplier").select("s_suppkey", F.lit("EUR").alias("currency"), F.lit(1).alias("active"))


@query(
    "proj_case_when",
    """
    SELECT p_partkey, CASE WHEN p_size >= 30 THEN 'large' ELSE 'small' END AS size_class FROM part
    """,
)
def proj_case_when(spark: SparkSession, d: str) -> DataFrame:
    size_class = F.when(F.col("p_size") >= 30, "large").otherwise("small")
    return load(spark, d, "part").select("p_partkey", size_class.alias("size_class"))


@query(
    "proj_salary_band",
    """
    SELECT c_custkey, c_acctbal,
           CASE WHEN c_acctbal >= 7000 THEN 'Senior' WHEN c_acctbal >= 3000 THEN 'Mid' ELSE 'Junior' END AS band
    FROM customer
    """,
)
def proj_salary_band(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").select(
        "c_custkey", "c_acctbal", salary_band(F.col("c_acctbal"), 7000, 3000).alias("band")
    )


@query(
    "proj_arith",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS bigint) + 1 AS plus_one,
           CAST(l_quantity AS bigint) - 1 AS minus_one, l_quantity * 2 AS doubled, l_quantity / 4 AS quarter,
           l_orderkey % 10 AS mod_ten, CAST(l_linenumber * l_linenumber AS double) AS squared
    FROM lineitem
    """,
)
def proj_arith(spark: SparkSession, d: str) -> DataFrame:
    whole = F.col("l_quantity").cast("long")
    return load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (whole + 1).alias("plus_one"),
        (whole - 1).alias("minus_one"),
        (F.col("l_quantity") * 2).alias("doubled"),
        (F.col("l_quantity") / 4).alias("quarter"),
        (F.col("l_orderkey") % 10).alias("mod_ten"),
        F.pow("l_linenumber", F.lit(2)).alias("squared"),
    )


@query(
    "proj_cast",
    """
    SELECT event_id, CAST(event_id AS varchar) AS id_text, TRY_CAST(props AS int) AS props_number,
           CAST(floor(value) AS int) AS whole_value, CAST(user_id AS double) AS user_number
    FROM events
    """,
)
def proj_cast(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").select(
        "event_id",
        F.col("event_id").cast("string").alias("id_text"),
        F.col("props").try_cast("int").alias("props_number"),
        F.floor("value").cast("int").alias("whole_value"),
        F.col("user_id").cast("double").alias("user_number"),
    )


@query("filt_sql_expr", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def filt_sql_expr(spark: SparkSession, d: str) -> DataFrame:
    condition = F.expr("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
    return load(spark, d, "orders").filter(condition).select("o_orderkey", "o_totalprice")


@query("proj_rename", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal AS balance FROM supplier")
def proj_rename(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "supplier").withColumnsRenamed(
        {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_acctbal": "balance"}
    )


@query("proj_drop", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def proj_drop(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").drop("o_orderdate", "o_orderpriority")


@query("filt_compare", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 30")
def filt_compare(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").filter(F.col("p_size") > 30).select("p_partkey", "p_name", "p_size")


@query(
    "filt_conjunction",
    """
    SELECT o_orderkey FROM orders
    WHERE o_orderstatus = 'F' AND (o_orderpriority = '1-URGENT' OR o_totalprice > 400000) AND NOT o_custkey < 100
    """,
)
def filt_conjunction(spark: SparkSession, d: str) -> DataFrame:
    return (
        load(spark, d, "orders")
        .filter(
            (F.col("o_orderstatus") == "F")
            & ((F.col("o_orderpriority") == "1-URGENT") | (F.col("o_totalprice") > 400000))
            & ~(F.col("o_custkey") < 100)
        )
        .select("o_orderkey")
    )


@query("filt_typed_equiv", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000")
def filt_typed_equiv(spark: SparkSession, d: str) -> DataFrame:
    wanted = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 5000)
    return load(spark, d, "customer").filter(wanted).select("c_custkey", "c_name")


def orders_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The test tables hold no NULL; finished orders lose their status and cheap ones their price here."""
    return load(spark, d, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("price"),
        "o_orderpriority",
    )


GAPS = """
    WITH gaps AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status,
                         CASE WHEN o_totalprice >= 50000 THEN o_totalprice END AS price, o_orderpriority
                  FROM orders)
"""


@query("null_not_null", GAPS + "SELECT o_orderkey, status FROM gaps WHERE status IS NOT NULL")
def null_not_null(spark: SparkSession, d: str) -> DataFrame:
    gaps = orders_with_gaps(spark, d)
    return gaps.filter(F.col("status").isNotNull()).select("o_orderkey", "status")


@query("null_dropna", GAPS + "SELECT * FROM gaps WHERE status IS NOT NULL AND price IS NOT NULL")
def null_dropna(spark: SparkSession, d: str) -> DataFrame:
    return orders_with_gaps(spark, d).dropna(subset=["status", "price"])


@query(
    "null_fillna",
    GAPS + "SELECT o_orderkey, coalesce(status, 'unknown') AS status, coalesce(price, 0.0) AS price, o_orderpriority FROM gaps",
)
def null_fillna(spark: SparkSession, d: str) -> DataFrame:
    return orders_with_gaps(spark, d).fillna({"status": "unknown", "price": 0.0})


@query(
    "null_fillna_all",
    GAPS + "SELECT o_orderkey, coalesce(status, 'n/a') AS status, price, coalesce(o_orderpriority, 'n/a') AS o_orderpriority FROM gaps",
)
def null_fillna_all(spark: SparkSession, d: str) -> DataFrame:
    return orders_with_gaps(spark, d).fillna("n/a")


@query(
    "val_replace",
    """
    SELECT o_orderkey, o_orderpriority,
           CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus
    FROM orders
    """,
)
def val_replace(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return orders.replace({"F": "finished", "O": "open"}, subset=["o_orderstatus"])


@query(
    "dedup_subset",
    """
    SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1
    """,
)
def dedup_subset(spark: SparkSession, d: str) -> DataFrame:
    newest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    kept = deduplicate(load(spark, d, "orders"), ["o_custkey", "o_orderpriority"], newest)
    return kept.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@query("dedup_rows", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


@query(
    "proj_price_tier",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, unit_price,
           CASE WHEN unit_price <= 0 THEN NULL WHEN unit_price <= 100 THEN 'budget'
                WHEN unit_price <= 500 THEN 'mid-range' ELSE 'premium' END AS tier
    FROM (SELECT *, CAST(CAST(l_extendedprice AS decimal(18,2)) AS double) / 50 AS unit_price FROM lineitem)
    """,
)
def proj_price_tier(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "lineitem").withColumn("unit_price", money("l_extendedprice").cast("double") / 50)
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "unit_price", price_tier(F.col("unit_price")).alias("tier")
    )
