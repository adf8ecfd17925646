"""Whole jobs as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import bonus_on, money, tax_on
from loomwell.operators.versions import VersionedTable
from loomwell.plans.jobs import best_orders_per_group, clean_orders, monthly_summary, orders_as_raw, word_count
from loomwell.plans.registry import query
from loomwell.plans.reshape_queries import WORDS
from loomwell.session import scratch_path
from loomwell.sources.files import write_partitioned
from loomwell.sources.tables import load


@query(
    "segment_revenue",
    """
    SELECT c_mktsegment, CAST(year(o_orderdate) AS int) AS yr, CAST(month(o_orderdate) AS int) AS mon, count(*) AS order_count,
           CAST(sum(CAST(o_totalprice AS decimal(18,2))
                    + CAST(round(CAST(o_totalprice AS decimal(18,2)) * CAST(0.18 AS decimal(3,2)), 2) AS decimal(18,2))) AS double) AS total_revenue,
           CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) / count(*) AS avg_order_value
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 0 GROUP BY 1, 2, 3
    """,
)
def segment_revenue(spark: SparkSession, d: str) -> DataFrame:
    """Monthly taxed revenue and mean order value per customer segment."""
    # each exact price is worked out once, before the join, and reused by the sums
    orders = (
        load(spark, d, "orders")
        .filter(F.col("o_totalprice") > 0)
        .select(
            "o_custkey",
            F.year("o_orderdate").alias("yr"),
            F.month("o_orderdate").alias("mon"),
            money("o_totalprice").alias("price"),
        )
        .withColumn("taxed", F.col("price") + tax_on(F.col("price")))
    )
    return (
        orders.join(load(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", "yr", "mon")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("taxed").cast("double").alias("total_revenue"),
            (F.sum("price").cast("double") / F.count(F.lit(1))).alias("avg_order_value"),
        )
    )


@query("pipe_word_count", WORDS + "SELECT word, occurrences FROM c")
def pipe_word_count(spark: SparkSession, d: str) -> DataFrame:
    # the word breaks ties, so the many words seen once can be split over tasks
    return word_count(load(spark, d, "documents"), "text").orderBy(F.desc("occurrences"), "word")


ETL = """
    WITH clean AS (
        SELECT o_orderkey, upper(c_mktsegment) AS category, o_orderpriority AS product,
               CAST(o_totalprice AS decimal(18,2)) AS amount,
               CAST(round(CAST(o_totalprice AS decimal(18,2)) * CAST(0.18 AS decimal(3,2)), 2) AS decimal(18,2)) AS tax,
               CAST(o_orderdate AS date) AS order_date, CAST(year(o_orderdate) AS int) AS year, CAST(month(o_orderdate) AS int) AS month
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 0)
"""


def etl_clean(spark: SparkSession, d: str) -> DataFrame:
    return clean_orders(orders_as_raw(load(spark, d, "orders"), load(spark, d, "customer")))


@query(
    "pipe_etl_clean",
    ETL
    + """
    SELECT CAST(o_orderkey AS varchar) AS order_id, category, product, CAST(amount AS double) AS amount, CAST(tax AS double) AS tax,
           CAST(amount + tax AS double) AS total_amount, order_date, year, month FROM clean
    """,
)
def pipe_etl_clean(spark: SparkSession, d: str) -> DataFrame:
    clean = etl_clean(spark, d).drop("customer_id")
    return clean.withColumns({c: F.col(c).cast("double") for c in ("amount", "tax", "total_amount")})


@query(
    "pipe_etl_summary",
    ETL
    + """
    SELECT category, year, month, count(*) AS order_count, CAST(sum(amount + tax) AS double) AS total_revenue,
           CAST((2 * CAST(sum(amount) * 100 AS bigint) + count(*)) // (2 * count(*)) AS double) / 100 AS avg_order_value
    FROM clean GROUP BY 1, 2, 3
    """,
)
def pipe_etl_summary(spark: SparkSession, d: str) -> DataFrame:
    summary = monthly_summary(etl_clean(spark, d))
    return summary.withColumns({c: F.col(c).cast("double") for c in ("total_revenue", "avg_order_value")}).orderBy(
        "category", "year", "month"
    )


@query(
    "pipe_etl_load",
    ETL + "SELECT year, month, count(*) AS orders, CAST(sum(amount + tax) AS double) AS total FROM clean GROUP BY 1, 2",
)
def pipe_etl_load(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "etl")
    write_partitioned(etl_clean(spark, d), path, ["year", "month"])
    stored = spark.read.parquet(path)
    return stored.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").cast("double").alias("total")
    )


@query(
    "pipe_upsert",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '.updated' ELSE c_name END AS c_name, c_mktsegment, true AS is_active
    FROM customer
    UNION ALL SELECT -1 - s_suppkey, s_name, 'SUPPLIER', true FROM supplier
    """,
)
def pipe_upsert(spark: SparkSession, d: str) -> DataFrame:
    """First run loads the customers; the next merges renamed ones and new ones from the suppliers."""
    table = VersionedTable(spark, scratch_path(spark, "upsert"), ["c_custkey"])
    stamp = {"last_updated": F.current_timestamp(), "is_active": F.lit(True)}
    customers = load(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    table.create(customers.withColumns(stamp))
    renamed = customers.filter(F.col("c_mktsegment") == "BUILDING").withColumn(
        "c_name", F.concat("c_name", F.lit(".updated"))
    )
    added = load(spark, d, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    table.merge(renamed.unionByName(added).withColumns(stamp))
    return table.as_of().drop("last_updated")


@query(
    "pipe_top_orders_by_country",
    """
    WITH r AS (SELECT n_name, o_totalprice, rank() OVER (PARTITION BY n_name ORDER BY o_totalprice DESC) AS rnk
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
               WHERE o_totalprice >= 100000)
    SELECT n_name, count(*) AS top_orders, CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS top_total,
           max(o_totalprice) AS largest
    FROM r WHERE rnk <= 5 GROUP BY 1
    """,
)
def pipe_top_orders_by_country(spark: SparkSession, d: str) -> DataFrame:
    customers = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return best_orders_per_group(load(spark, d, "orders"), customers, F.lit(100000), "n_name", 5)


@query(
    "pipe_group_stats",
    """
    SELECT CAST(l_orderkey % 10 AS int) AS key, count(*) AS n,
           CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS total,
           CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) / count(*) AS mean
    FROM lineitem GROUP BY 1
    """,
)
def pipe_group_stats(spark: SparkSession, d: str) -> DataFrame:
    price = money("l_extendedprice")
    grouped = load(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 10).cast("int").alias("key"))
    return grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(price).cast("double").alias("total"),
        (F.sum(price).cast("double") / F.count(F.lit(1))).alias("mean"),
    )


@query(
    "pipe_total_comp",
    """
    SELECT c_custkey, c_acctbal,
           CAST(round(CAST(c_acctbal AS decimal(18,2)) * CAST(0.10 AS decimal(3,2)), 2) AS double) AS bonus,
           CAST(CAST(c_acctbal AS decimal(18,2)) + round(CAST(c_acctbal AS decimal(18,2)) * CAST(0.10 AS decimal(3,2)), 2) AS double) AS total_comp
    FROM customer
    """,
)
def pipe_total_comp(spark: SparkSession, d: str) -> DataFrame:
    salary = money("c_acctbal")
    return load(spark, d, "customer").select(
        "c_custkey",
        "c_acctbal",
        bonus_on(salary).cast("double").alias("bonus"),
        (salary + bonus_on(salary)).cast("double").alias("total_comp"),
    )
