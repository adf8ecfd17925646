"""Equi-joins, hinted joins and joins on skewed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.operators.joins import (
    broadcast_if_small,
    cross_with_values,
    filter_by_match,
    key_skew,
    product_of_small,
    runtime_filter_session,
    salted_join,
)
from loomwell.plans.registry import query
from loomwell.sources.tables import load

ORDER_CUSTOMER = """
    SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
"""


def order_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("join_inner", ORDER_CUSTOMER)
def join_inner(spark: SparkSession, d: str) -> DataFrame:
    return order_customer(load(spark, d, "orders"), load(spark, d, "customer"))


@query("join_left", "SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def join_left(spark: SparkSession, d: str) -> DataFrame:
    documents = load(spark, d, "documents").select("doc_id", "lang")
    return documents.join(load(spark, d, "labels"), on="doc_id", how="left")


@query("join_right", "SELECT doc_id, quality, lang FROM labels RIGHT JOIN documents USING (doc_id)")
def join_right(spark: SparkSession, d: str) -> DataFrame:
    documents = load(spark, d, "documents").select("doc_id", "lang")
    return load(spark, d, "labels").select("doc_id", "quality").join(documents, on="doc_id", how="right")


@query(
    "join_full",
    """
    SELECT coalesce(e.doc_id, g.doc_id) AS doc_id, lang, quality
    FROM (SELECT doc_id, lang FROM documents WHERE lang = 'en') e
    FULL JOIN (SELECT doc_id, quality FROM labels WHERE quality = 1) g ON e.doc_id = g.doc_id
    """,
)
def join_full(spark: SparkSession, d: str) -> DataFrame:
    # doc_id is unique on both sides, so no key can be hot
    english = load(spark, d, "documents").filter(F.col("lang") == "en").select("doc_id", "lang")
    good = load(spark, d, "labels").filter(F.col("quality") == 1).select("doc_id", "quality")
    return english.join(good, on="doc_id", how="full")


@query(
    "join_semi",
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    """,
)
def join_semi(spark: SparkSession, d: str) -> DataFrame:
    returned = load(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return filter_by_match(orders, returned, "o_orderkey", "l_orderkey")


@query(
    "join_anti",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def join_anti(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return filter_by_match(orders, load(spark, d, "lineitem"), "o_orderkey", "l_orderkey", anti=True)


@query(
    "join_cross",
    "SELECT o_orderkey, scenario, o_totalprice * scenario AS scaled FROM orders CROSS JOIN (VALUES (1), (2), (3)) v(scenario)",
)
def join_cross(spark: SparkSession, d: str) -> DataFrame:
    crossed = cross_with_values(load(spark, d, "orders"), "scenario", [1, 2, 3])
    return crossed.select("o_orderkey", "scenario", (F.col("o_totalprice") * F.col("scenario")).alias("scaled"))


@query(
    "join_broadcast",
    "SELECT c_custkey, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def join_broadcast(spark: SparkSession, d: str) -> DataFrame:
    nations = broadcast_if_small(load(spark, d, "nation"))
    joined = load(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "c_mktsegment", "n_name")


@query("join_sort_merge", ORDER_CUSTOMER)
def join_sort_merge(spark: SparkSession, d: str) -> DataFrame:
    return order_customer(load(spark, d, "orders"), load(spark, d, "customer").hint("merge"))


@query(
    "join_multi_key",
    """
    WITH r AS (SELECT l_partkey, l_suppkey, sum(CAST(l_quantity AS bigint)) AS returned FROM lineitem
               WHERE l_returnflag = 'R' GROUP BY ALL),
         k AS (SELECT l_partkey, l_suppkey, sum(CAST(l_quantity AS bigint)) AS kept FROM lineitem
               WHERE l_returnflag <> 'R' GROUP BY ALL)
    SELECT l_partkey, l_suppkey, CAST(returned AS bigint) AS returned, CAST(kept AS bigint) AS kept
    FROM r JOIN k USING (l_partkey, l_suppkey)
    """,
)
def join_multi_key(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "lineitem")
    key = ["l_partkey", "l_suppkey"]
    quantity = F.sum(F.col("l_quantity").cast("long"))
    returned = lines.filter(F.col("l_returnflag") == "R").groupBy(*key).agg(quantity.alias("returned"))
    kept = lines.filter(F.col("l_returnflag") != "R").groupBy(*key).agg(quantity.alias("kept"))
    return returned.join(kept, on=key)


def skewed_orders(spark: SparkSession, d: str) -> DataFrame:
    """All orders, about 99% of them moved to customer 1."""
    hot = F.when(F.pmod("o_custkey", F.lit(100)) < 99, F.lit(1).cast("long")).otherwise(F.col("o_custkey"))
    return load(spark, d, "orders").select("o_orderkey", "o_totalprice", hot.alias("c_custkey"))


SKEWED = """
    WITH s AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_custkey % 100 < 99 THEN 1 ELSE o_custkey END AS k FROM orders)
"""
SKEWED_AGG = (
    SKEWED
    + """
    SELECT c_mktsegment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS total
    FROM s JOIN customer ON k = c_custkey GROUP BY 1
    """
)


def by_segment(joined: DataFrame) -> DataFrame:
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).cast("double").alias("total")
    )


@query("join_skewed_baseline", SKEWED_AGG)
def join_skewed_baseline(spark: SparkSession, d: str) -> DataFrame:
    """A plain shuffle join: the rows of the hot key stream past their customer and are not sorted, so no task holds them."""
    customers = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return by_segment(skewed_orders(spark, d).join(customers.hint("shuffle_hash"), "c_custkey"))


@query("join_salted", SKEWED + "SELECT o_orderkey, c_custkey, c_mktsegment FROM s JOIN customer ON k = c_custkey")
def join_salted(spark: SparkSession, d: str) -> DataFrame:
    customers = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    joined = salted_join(skewed_orders(spark, d), customers, ["c_custkey"], row_key=["o_orderkey"], rows_per_task=1000)
    return joined.select("o_orderkey", "c_custkey", "c_mktsegment")


@query("join_salted_agg", SKEWED_AGG)
def join_salted_agg(spark: SparkSession, d: str) -> DataFrame:
    customers = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return by_segment(salted_join(skewed_orders(spark, d), customers, ["c_custkey"], row_key=["o_orderkey"]))


FILTERED_JOIN = """
    SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_totalprice > 300000 AND c_mktsegment = 'BUILDING'
"""


@query("join_filter_after", FILTERED_JOIN)
def join_filter_after(spark: SparkSession, d: str) -> DataFrame:
    orders, customers = load(spark, d, "orders"), load(spark, d, "customer")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .filter((F.col("o_totalprice") > 300000) & (F.col("c_mktsegment") == "BUILDING"))
        .select("o_orderkey", "o_totalprice", "c_name")
    )


@query("join_filter_before", FILTERED_JOIN)
def join_filter_before(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").filter(F.col("o_totalprice") > 300000)
    customers = load(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "o_totalprice", "c_name")


@query("join_pruned", "SELECT c_name, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")
def join_pruned(spark: SparkSession, d: str) -> DataFrame:
    lines, orders, customers = (load(spark, d, t) for t in ("lineitem", "orders", "customer"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_name", "l_quantity")
    )


@query(
    "join_enrich",
    """
    SELECT o_orderkey, o_totalprice, c_mktsegment AS tier
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
    """,
)
def join_enrich(spark: SparkSession, d: str) -> DataFrame:
    solvent = load(spark, d, "customer").filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_mktsegment")
    joined = load(spark, d, "orders").join(
        broadcast_if_small(solvent), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    return joined.select("o_orderkey", "o_totalprice", F.col("c_mktsegment").alias("tier"))


@query(
    "skew_profile",
    """
    WITH c AS (SELECT user_id, count(*) AS "rows" FROM events GROUP BY 1)
    SELECT user_id, "rows", CAST("rows" AS double) / (SELECT sum("rows") FROM c) AS share,
           CAST("rows" * (SELECT count(*) FROM c) AS double) / (SELECT sum("rows") FROM c) AS ratio_to_mean
    FROM c
    """,
)
def skew_profile(spark: SparkSession, d: str) -> DataFrame:
    return key_skew(load(spark, d, "events"), ["user_id"]).orderBy(F.desc("rows"), "user_id")


BLOOM = """
    SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderpriority = '{0}' AND o_totalprice > 300000
"""


def bloom_join(spark: SparkSession, d: str, priority: str) -> DataFrame:
    session = runtime_filter_session(spark)
    orders = load(session, d, "orders").filter((F.col("o_orderpriority") == priority) & (F.col("o_totalprice") > 300000))
    joined = load(session, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate")


@query("join_bloom_filtered", BLOOM.format("1-URGENT"))
def join_bloom_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Few orders are left, so the lines are filtered where they are scanned and few are shuffled."""
    return bloom_join(spark, d, "1-URGENT")


@query("join_bloom_no_match", BLOOM.format("none"))
def join_bloom_no_match(spark: SparkSession, d: str) -> DataFrame:
    return bloom_join(spark, d, "none")


@query(
    "join_product",
    "SELECT r_name, n_name, r_regionkey = n_regionkey AS belongs FROM region CROSS JOIN nation",
)
def join_product(spark: SparkSession, d: str) -> DataFrame:
    pairs = product_of_small(load(spark, d, "region"), load(spark, d, "nation"))
    return pairs.select("r_name", "n_name", (F.col("r_regionkey") == F.col("n_regionkey")).alias("belongs"))
