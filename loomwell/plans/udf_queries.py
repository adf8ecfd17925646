"""Python and pandas functions; each result is also reachable with built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions import udfs
from loomwell.functions.text import normalise_name
from loomwell.plans.registry import query
from loomwell.plans.scalar_queries import PROPER
from loomwell.sources.tables import load

CLEAN = f"SELECT p_partkey, {PROPER.format('p_name')} AS name FROM part"


def messy_names(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit(" "), F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit(" "))
    return load(spark, d, "part").select("p_partkey", raw.alias("raw_name"))


def cleaned(spark: SparkSession, d: str, name: Column) -> DataFrame:
    return messy_names(spark, d).select("p_partkey", name.alias("name"))


@query("udf_python_name", CLEAN)
def udf_python_name(spark: SparkSession, d: str) -> DataFrame:
    return cleaned(spark, d, udfs.normalise_name_udf("raw_name"))


@query("udf_sql_registered", CLEAN)
def udf_sql_registered(spark: SparkSession, d: str) -> DataFrame:
    spark.udf.register("tidy_name", udfs.normalise_name_udf)
    messy_names(spark, d).createOrReplaceTempView("messy_names")
    return spark.sql("SELECT p_partkey, tidy_name(raw_name) AS name FROM messy_names")


@query("udf_pandas_name", CLEAN)
def udf_pandas_name(spark: SparkSession, d: str) -> DataFrame:
    return cleaned(spark, d, udfs.normalise_name_pandas("raw_name"))


@query("udf_pandas_iter", CLEAN)
def udf_pandas_iter(spark: SparkSession, d: str) -> DataFrame:
    return cleaned(spark, d, udfs.normalise_name_batches("raw_name"))


@query(
    "udf_vs_builtin",
    "SELECT count(*) AS names, CAST(0 AS bigint) AS differing FROM part",
)
def udf_vs_builtin(spark: SparkSession, d: str) -> DataFrame:
    odd = F.concat("raw_name", F.lit("o'neil-3rd_x2y "))
    both = messy_names(spark, d).select(
        udfs.normalise_name_udf(odd).alias("by_python"), normalise_name(odd).alias("by_spark")
    )
    return both.agg(
        F.count(F.lit(1)).alias("names"), F.count_if(~F.col("by_python").eqNullSafe(F.col("by_spark"))).alias("differing")
    )


@query(
    "udf_pandas_tier",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice / 800 <= 0 THEN NULL WHEN o_totalprice / 800 <= 100 THEN 'budget'
                            WHEN o_totalprice / 800 <= 500 THEN 'mid-range' ELSE 'premium' END AS tier
    FROM orders
    """,
)
def udf_pandas_tier(spark: SparkSession, d: str) -> DataFrame:
    unit = F.col("o_totalprice") / 800
    return load(spark, d, "orders").select("o_orderkey", udfs.price_tier_pandas(unit).alias("tier"))


@query(
    "udf_group_zscore",
    """
    SELECT c_custkey, c_mktsegment, c_acctbal,
           round((c_acctbal - avg(c_acctbal) OVER w) / stddev_samp(c_acctbal) OVER w, 3) AS z
    FROM customer WINDOW w AS (PARTITION BY c_mktsegment)
    """,
)
def udf_group_zscore(spark: SparkSession, d: str) -> DataFrame:
    customers = load(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return udfs.group_zscore(customers, ["c_mktsegment"], "c_custkey", "c_acctbal", "z", chunk_rows=100_000)


@query(
    "udf_map_in_pandas",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(round(l_extendedprice * 100) AS bigint) * (100 - CAST(round(l_discount * 100) AS bigint)) // 100 AS bigint) AS net_cents
    FROM lineitem
    """,
)
def udf_map_in_pandas(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("price_cents"),
        F.round(F.col("l_discount") * 100).cast("long").alias("discount_pct"),
    )
    return lines.mapInPandas(udfs.line_totals, "l_orderkey long, l_linenumber int, net_cents long")
