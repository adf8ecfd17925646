"""Grouped, subtotalled, pivoted and descriptive aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.operators.aggregates import (
    QUARTILES,
    collect_in_chunks,
    collect_set_in_chunks,
    distinct_by_level,
    profile,
    profile_text,
    quantiles_by_group,
    summarise,
    with_dense_code,
)
from loomwell.operators.windows import with_ntile, with_zscore
from loomwell.plans.registry import query
from loomwell.sources.tables import load


def exact_sum(c: str) -> Column:
    return F.sum(money(c)).cast("double")


def exact_avg(c: str) -> Column:
    return F.sum(money(c)).cast("double") / F.count(c)


@query("agg_global_count", "SELECT count(*) AS n FROM lineitem")
def agg_global_count(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("agg_group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def agg_group_count(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("agg_global_sum", "SELECT CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS total FROM lineitem")
def agg_global_sum(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "lineitem").agg(F.sum(F.col("l_quantity").cast("long")).alias("total"))


@query(
    "agg_full",
    """
    SELECT o_orderpriority, count(o_orderkey) AS order_count,
           CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS total_amount,
           CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) / count(o_totalprice) AS avg_amount,
           min(o_totalprice) AS min_amount, max(o_totalprice) AS max_amount,
           count(DISTINCT o_custkey) AS customers, round(stddev_samp(o_totalprice), 2) AS sd_amount,
           string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses
    FROM orders GROUP BY 1
    """,
)
def agg_full(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count("o_orderkey").alias("order_count"),
        exact_sum("o_totalprice").alias("total_amount"),
        exact_avg("o_totalprice").alias("avg_amount"),
        F.min("o_totalprice").alias("min_amount"),
        F.max("o_totalprice").alias("max_amount"),
        F.count_distinct("o_custkey").alias("customers"),
        F.round(F.stddev_samp("o_totalprice"), 2).alias("sd_amount"),
        # the status column has three possible values, so this set stays tiny
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"),
    )


@query(
    "agg_count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1",
)
def agg_count_distinct(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders")
    )


def joined_text(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@query(
    "agg_collect_list",
    """
    WITH r AS (SELECT p_brand, p_size, (row_number() OVER (PARTITION BY p_brand ORDER BY p_size) - 1) // 50 AS chunk FROM part)
    SELECT p_brand, CAST(chunk AS int) AS chunk, string_agg(CAST(p_size AS varchar), ',' ORDER BY p_size) AS sizes
    FROM r GROUP BY 1, 2
    """,
)
def agg_collect_list(spark: SparkSession, d: str) -> DataFrame:
    chunks = collect_in_chunks(load(spark, d, "part"), ["p_brand"], "p_size", "p_partkey", 50)
    return chunks.select("p_brand", "chunk", joined_text("values").alias("sizes"))


@query(
    "agg_collect_set",
    """
    WITH u AS (SELECT DISTINCT p_type, p_size FROM part),
         r AS (SELECT *, (row_number() OVER (PARTITION BY p_type ORDER BY p_size) - 1) // 20 AS chunk FROM u)
    SELECT p_type, CAST(chunk AS int) AS chunk, string_agg(CAST(p_size AS varchar), ',' ORDER BY p_size) AS sizes
    FROM r GROUP BY 1, 2
    """,
)
def agg_collect_set(spark: SparkSession, d: str) -> DataFrame:
    chunks = collect_set_in_chunks(load(spark, d, "part"), ["p_type"], "p_size", 20)
    return chunks.select("p_type", "chunk", joined_text("values").alias("sizes"))


@query(
    "agg_stddev",
    "SELECT o_custkey, round(stddev_samp(o_totalprice), 2) AS sd FROM orders GROUP BY 1",
)
def agg_stddev(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").groupBy("o_custkey").agg(F.round(F.stddev_samp("o_totalprice"), 2).alias("sd"))


@query(
    "agg_multi_key",
    """
    SELECT o_custkey, o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS total
    FROM orders GROUP BY 1, 2
    """,
)
def agg_multi_key(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("total")
    )


SUBTOTALS = """
    SELECT c_mktsegment, c_nationkey, CAST(grouping(c_mktsegment) AS int) AS all_segments,
           CAST(grouping(c_nationkey) AS int) AS all_nations, count(*) AS customers,
           CAST(sum(CAST(c_acctbal AS decimal(18,2))) AS double) AS balance
    FROM customer GROUP BY {0}(c_mktsegment, c_nationkey)
"""


def subtotal_columns() -> list[Column]:
    return [
        F.grouping("c_mktsegment").cast("int").alias("all_segments"),
        F.grouping("c_nationkey").cast("int").alias("all_nations"),
        F.count(F.lit(1)).alias("customers"),
        exact_sum("c_acctbal").alias("balance"),
    ]


@query("agg_rollup", SUBTOTALS.format("ROLLUP"))
def agg_rollup(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").rollup("c_mktsegment", "c_nationkey").agg(*subtotal_columns())


@query("agg_cube", SUBTOTALS.format("CUBE"))
def agg_cube(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").cube("c_mktsegment", "c_nationkey").agg(*subtotal_columns())


@query(
    "agg_rollup_distinct",
    """
    SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS bigint) AS level,
           count(DISTINCT l_partkey) AS parts
    FROM lineitem GROUP BY ROLLUP(l_returnflag, l_linestatus)
    """,
)
def agg_rollup_distinct(spark: SparkSession, d: str) -> DataFrame:
    return distinct_by_level(load(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_partkey", "rollup", "parts")


@query(
    "agg_cube_distinct",
    """
    SELECT event_type, weekday, k, CAST(grouping(event_type, weekday, k) AS bigint) AS level, count(DISTINCT value) AS amounts
    FROM (SELECT event_type, CAST(isodow(ts) AS int) AS weekday, nullif(event_id % 4, 3) AS k, CASE WHEN event_id % 11 > 0 THEN value END AS value FROM events)
    GROUP BY CUBE(event_type, weekday, k)
    """,
)
def agg_cube_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Amounts are no integers, so they are numbered first; some are NULL, as is one of the keys."""
    events = load(spark, d, "events").select(
        "event_type",
        (F.weekday("ts") + 1).alias("weekday"),
        F.nullif(F.col("event_id") % 4, F.lit(3)).alias("k"),
        F.when(F.col("event_id") % 11 > 0, F.col("value")).alias("value"),
    )
    return distinct_by_level(with_dense_code(events, "value", "code"), ["event_type", "weekday", "k"], "code", "cube", "amounts")


@query(
    "agg_null_key",
    """
    SELECT lang, quality, CAST(grouping(lang) AS int) AS all_langs, CAST(grouping(quality) AS int) AS all_qualities,
           count(*) AS docs, CAST(sum(n_chars) AS bigint) AS chars
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ROLLUP(lang, quality)
    """,
)
def agg_null_key(spark: SparkSession, d: str) -> DataFrame:
    documents = load(spark, d, "documents").select("doc_id", "lang", "n_chars")
    labelled = documents.join(load(spark, d, "labels"), "doc_id", "left")
    return labelled.rollup("lang", "quality").agg(
        F.grouping("lang").cast("int").alias("all_langs"),
        F.grouping("quality").cast("int").alias("all_qualities"),
        F.count(F.lit(1)).alias("docs"),
        F.sum("n_chars").alias("chars"),
    )


def pivot_oracle(values: dict[str, str], key: str, column: str) -> str:
    cells = ", ".join(
        f"CAST(sum(CAST(o_totalprice AS decimal(18,2))) FILTER (WHERE {column} = '{v}') AS double) AS \"{name}\""
        for v, name in values.items()
    )
    return f"SELECT {key}, {cells} FROM orders GROUP BY 1"


@query("pivot_single", pivot_oracle({"1-URGENT": "1-URGENT", "5-LOW": "5-LOW"}, "o_orderstatus", "o_orderpriority"))
def pivot_single(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    return orders.groupBy("o_orderstatus").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).agg(exact_sum("o_totalprice"))


@query(
    "pivot_multi",
    """
    SELECT o_custkey,
           CAST(sum(CAST(o_totalprice AS decimal(18,2))) FILTER (WHERE o_orderstatus = 'F') AS double) AS "F_total",
           nullif(count(o_orderkey) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F_orders",
           CAST(sum(CAST(o_totalprice AS decimal(18,2))) FILTER (WHERE o_orderstatus = 'O') AS double) AS "O_total",
           nullif(count(o_orderkey) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O_orders"
    FROM orders GROUP BY 1
    """,
)
def pivot_multi(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    return orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O"]).agg(
        exact_sum("o_totalprice").alias("total"), F.count("o_orderkey").alias("orders")
    )


@query("pivot_discover", pivot_oracle({"F": "F", "O": "O", "P": "P"}, "o_orderpriority", "o_orderstatus"))
def pivot_discover(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus").agg(exact_sum("o_totalprice"))


def describe_oracle(table: str, columns: list[str], quartiles: bool) -> str:
    def one(c: str) -> str:
        q = "".join(
            f", round(quantile_cont({c}, {p}), 4) AS {n}" for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
        )
        return (
            f"SELECT '{c}' AS column_name, count({c}) AS n, count(*) - count({c}) AS n_null, round(avg({c}), 4) AS mean,"
            f" round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS double) AS min, CAST(max({c}) AS double) AS max"
            f"{q if quartiles else ''} FROM {table}"
        )

    return " UNION ALL ".join(one(c) for c in columns)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query("stats_describe", describe_oracle("lineitem", ["l_quantity", "l_extendedprice", "l_discount"], False))
def stats_describe(spark: SparkSession, d: str) -> DataFrame:
    described = profile(load(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(described, "mean", "stddev")


@query(
    "stats_describe_text",
    """
    SELECT 'o_orderpriority' AS column_name, count(o_orderpriority) AS n, count(*) - count(o_orderpriority) AS n_null,
           avg(TRY_CAST(o_orderpriority AS double)) AS mean, min(o_orderpriority) AS min, max(o_orderpriority) AS max
    FROM orders
    UNION ALL
    SELECT 'o_orderstatus', count(o_orderstatus), count(*) - count(o_orderstatus),
           avg(TRY_CAST(o_orderstatus AS double)), min(o_orderstatus), max(o_orderstatus)
    FROM orders
    """,
)
def stats_describe_text(spark: SparkSession, d: str) -> DataFrame:
    return profile_text(load(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("stats_summary", describe_oracle("orders", ["o_totalprice", "o_custkey"], True))
def stats_summary(spark: SparkSession, d: str) -> DataFrame:
    described = summarise(load(spark, d, "orders"), ["o_totalprice", "o_custkey"])
    return rounded(described, "mean", "stddev", "q25", "q50", "q75")


@query("stats_summary_wide", describe_oracle("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"], True))
def stats_summary_wide(spark: SparkSession, d: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"]
    return rounded(summarise(load(spark, d, "lineitem"), columns), "mean", "stddev", "q25", "q50", "q75")


@query(
    "stats_quartiles_by_group",
    """
    SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
           round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75
    FROM lineitem GROUP BY 1, 2
    """,
)
def stats_quartiles_by_group(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "lineitem")
    quartiles = quantiles_by_group(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", QUARTILES)
    return rounded(quartiles, *QUARTILES)


@query(
    "stats_zscore_check",
    """
    WITH z AS (SELECT c_mktsegment, round((c_acctbal - avg(c_acctbal) OVER w) / stddev_samp(c_acctbal) OVER w, 3) AS z
               FROM customer WINDOW w AS (PARTITION BY c_mktsegment))
    SELECT c_mktsegment, round(avg(z), 3) + 0.0 AS mean_z, round(stddev_samp(z), 3) AS sd_z FROM z GROUP BY 1
    """,
)
def stats_zscore_check(spark: SparkSession, d: str) -> DataFrame:
    scored = with_zscore(load(spark, d, "customer"), ["c_mktsegment"], "c_acctbal", "z")
    return scored.groupBy("c_mktsegment").agg(
        (F.round(F.avg("z"), 3) + F.lit(0.0)).alias("mean_z"), F.round(F.stddev_samp("z"), 3).alias("sd_z")
    )


@query(
    "agg_having",
    """
    SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS total
    FROM orders GROUP BY 1 HAVING sum(CAST(o_totalprice AS decimal(18,2))) > 3000000
    """,
)
def agg_having(spark: SparkSession, d: str) -> DataFrame:
    totals = load(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).alias("total")
    )
    return totals.filter(F.col("total") > 3000000).withColumn("total", F.col("total").cast("double"))


@query(
    "agg_of_ntile",
    """
    WITH t AS (SELECT c_mktsegment, c_acctbal,
                      ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS quartile FROM customer)
    SELECT c_mktsegment, CAST(quartile AS int) AS quartile, count(*) AS customers, min(c_acctbal) AS lowest, max(c_acctbal) AS highest
    FROM t GROUP BY 1, 2
    """,
)
def agg_of_ntile(spark: SparkSession, d: str) -> DataFrame:
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    tiled = with_ntile(load(spark, d, "customer"), ["c_mktsegment"], order, {"quartile": 4})
    return tiled.groupBy("c_mktsegment", "quartile").agg(
        F.count(F.lit(1)).alias("customers"), F.min("c_acctbal").alias("lowest"), F.max("c_acctbal").alias("highest")
    )


@query(
    "agg_dept_stats",
    """
    SELECT c_mktsegment, count(*) AS headcount,
           round(CAST(sum(CAST(c_acctbal AS decimal(18,2))) AS double) / count(*), 2) AS avg_salary,
           max(c_acctbal) AS max_salary, min(c_acctbal) AS min_salary
    FROM customer GROUP BY 1
    """,
)
def agg_dept_stats(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("headcount"),
        F.round(exact_avg("c_acctbal"), 2).alias("avg_salary"),
        F.max("c_acctbal").alias("max_salary"),
        F.min("c_acctbal").alias("min_salary"),
    )


@query("agg_typed_avg", "SELECT CAST(sum(CAST(s_acctbal AS decimal(18,2))) AS double) / count(*) AS average FROM supplier")
def agg_typed_avg(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "supplier").agg(exact_avg("s_acctbal").alias("average"))
