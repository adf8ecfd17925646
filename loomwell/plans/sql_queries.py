"""Spark SQL text over registered views, beside the DataFrame form of the same question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.plans.registry import query
from loomwell.session import scratch_path
from loomwell.sources.tables import load


def register(spark: SparkSession, d: str, *names: str) -> None:
    for name in names:
        load(spark, d, name).createOrReplaceTempView(name)


NEWEST = "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5"


@query("sql_select_limit", NEWEST)
def sql_select_limit(spark: SparkSession, d: str) -> DataFrame:
    register(spark, d, "orders")
    return spark.sql(NEWEST)


REVENUE = """
    SELECT p_type, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY revenue DESC
"""


@query("sql_group_revenue", REVENUE)
def sql_group_revenue(spark: SparkSession, d: str) -> DataFrame:
    register(spark, d, "lineitem", "part")
    return spark.sql(REVENUE)


@query("df_group_revenue", REVENUE)
def df_group_revenue(spark: SparkSession, d: str) -> DataFrame:
    return (
        load(spark, d, "lineitem")
        .join(load(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum(money("l_extendedprice")).cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


RANKED = """
    WITH sales AS (
        SELECT p_type, p_brand, sum(CAST(l_extendedprice AS decimal(18,2))) AS revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_brand),
    strong AS (
        SELECT p_type, p_brand, sum(revenue) AS revenue FROM sales
        GROUP BY p_type, p_brand HAVING sum(revenue) > 50)
    SELECT p_type, p_brand, CAST(revenue AS double) AS revenue,
           CAST(rank() OVER (PARTITION BY p_type ORDER BY revenue DESC) AS int) AS rank_in_type
    FROM strong
"""


@query("sql_cte_having_rank", RANKED)
def sql_cte_having_rank(spark: SparkSession, d: str) -> DataFrame:
    register(spark, d, "lineitem", "part")
    return spark.sql(RANKED)


NATION_LINES = """
    SELECT n_name, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS price
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey
    WHERE n_name IN ('FRANCE', 'JAPAN') AND o_orderdate >= '2000-01-01' GROUP BY n_name
"""


def measured_tables(spark: SparkSession, d: str) -> dict[str, str]:
    """The tables that the join reads, saved with row counts and column statistics; names by table."""
    names = {}
    for table in ("lineitem", "orders", "customer", "nation"):
        path = scratch_path(spark, f"measured-{table}")
        name = f"measured_{table}_{path[-32:]}"
        rows = load(spark, d, table)
        rows.write.option("path", path).saveAsTable(name)
        # Spark's estimates do not know times without a zone
        known = [f.name for f in rows.schema.fields if f.dataType.typeName() != "timestamp_ntz"]
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(known)}")
        names[table] = name
    return names


def cost_based_session(spark: SparkSession) -> SparkSession:
    """A session that orders joins by the statistics of their tables, and estimates filters with them."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.cbo.enabled", True)
    session.conf.set("spark.sql.cbo.joinReorder.enabled", True)
    return session


@query("sql_cost_based_joins", NATION_LINES.format(lineitem="lineitem", orders="orders", customer="customer", nation="nation"))
def sql_cost_based_joins(spark: SparkSession, d: str) -> DataFrame:
    """Written from the largest table to the smallest; the statistics turn the order round."""
    return cost_based_session(spark).sql(NATION_LINES.format(**measured_tables(spark, d)))
