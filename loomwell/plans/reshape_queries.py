"""Explode, replicate, append, sorts, limits, and the collection-style operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwell.functions.text import word_rows
from loomwell.operators.layout import keys_per_partition, partition_sizes, schema_frame, sort_within
from loomwell.operators.reshape import append_all, replicate
from loomwell.plans.jobs import word_count
from loomwell.plans.registry import query
from loomwell.sources.tables import load

TAGGED = """
    WITH t AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN CAST([] AS varchar[])
                                  ELSE string_split(o_orderpriority, '-') END AS tags FROM orders)
"""


def tagged_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders with a tag list that is NULL, empty or filled, depending on the status."""
    tags = (
        F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("array<string>"))
        .when(F.col("o_orderstatus") == "P", F.array().cast("array<string>"))
        .otherwise(F.split("o_orderpriority", "-"))
    )
    return load(spark, d, "orders").select("o_orderkey", tags.alias("tags"))


@query("explode_array", TAGGED + "SELECT o_orderkey, unnest(tags) AS tag FROM t")
def explode_array(spark: SparkSession, d: str) -> DataFrame:
    return tagged_orders(spark, d).select("o_orderkey", F.explode("tags").alias("tag"))


@query(
    "explode_outer_array",
    TAGGED
    + """
    SELECT o_orderkey, unnest(tags) AS tag FROM t
    UNION ALL SELECT o_orderkey, NULL FROM t WHERE tags IS NULL OR len(tags) = 0
    """,
)
def explode_outer_array(spark: SparkSession, d: str) -> DataFrame:
    return tagged_orders(spark, d).select("o_orderkey", F.explode_outer("tags").alias("tag"))


@query("explode_map", "SELECT event_id, 'k' AS name, CAST(props->>'$.k' AS bigint) AS amount FROM events")
def explode_map(spark: SparkSession, d: str) -> DataFrame:
    props = F.from_json("props", "map<string,bigint>")
    return load(spark, d, "events").select("event_id", F.explode(props).alias("name", "amount"))


@query("replicate_rows", "SELECT s_suppkey, copy FROM supplier CROSS JOIN (VALUES (0), (1), (2), (3)) c(copy)")
def replicate_rows(spark: SparkSession, d: str) -> DataFrame:
    return replicate(load(spark, d, "supplier").select("s_suppkey"), 4)


@query(
    "append_union",
    """
    SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
    """,
)
def append_union(spark: SparkSession, d: str) -> DataFrame:
    customers = load(spark, d, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    # another column order and one column fewer: matched by name
    suppliers = load(spark, d, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key")
    )
    return append_all(customers, suppliers)


@query("sort_global", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def sort_global(spark: SparkSession, d: str) -> DataFrame:
    # the unique second key lets the range partitioner cut through equal dates
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return orders.orderBy(F.asc("o_orderdate"), F.desc("o_orderkey"))


@query("sort_nulls_last", "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status FROM orders")
def sort_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("F")).alias("status")
    orders = load(spark, d, "orders").select("o_orderkey", status)
    return orders.orderBy(F.asc_nulls_last("status"), "o_orderkey")


@query(
    "sort_desc_arg",
    "SELECT l_suppkey, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS quantity FROM lineitem GROUP BY 1",
)
def sort_desc_arg(spark: SparkSession, d: str) -> DataFrame:
    totals = load(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    return totals.orderBy("quantity", "l_suppkey", ascending=False)


@query("limit_ordered", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def limit_ordered(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


WORDS = """
    WITH w AS (SELECT unnest(string_split_regex(lower(text), '\\s+')) AS word FROM documents),
         c AS (SELECT word, count(*) AS occurrences FROM w WHERE word <> '' GROUP BY 1)
"""


@query("topk_words", WORDS + "SELECT word, occurrences FROM c ORDER BY occurrences DESC, word LIMIT 20")
def topk_words(spark: SparkSession, d: str) -> DataFrame:
    return word_count(load(spark, d, "documents"), "text").orderBy(F.desc("occurrences"), "word").limit(20)


@query("word_count", WORDS + "SELECT word, occurrences FROM c")
def word_count_query(spark: SparkSession, d: str) -> DataFrame:
    return word_count(load(spark, d, "documents"), "text").orderBy(F.desc("occurrences"), "word")


@query("sort_large", "SELECT l_orderkey, l_linenumber, sha256(l_orderkey || ':' || l_partkey || ':' || l_linenumber) AS payload FROM lineitem")
def sort_large(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws(":", "l_orderkey", "l_partkey", "l_linenumber")
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    hashed = lines.select("l_orderkey", "l_linenumber", F.sha2(text, 256).alias("payload"))
    return hashed.orderBy("payload", "l_orderkey", "l_linenumber")


@query(
    "rdd_map_filter",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity * l_quantity AS bigint) AS squared FROM lineitem WHERE CAST(l_quantity AS bigint) % 2 = 0",
)
def rdd_map_filter(spark: SparkSession, d: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("long")
    even = load(spark, d, "lineitem").filter(quantity % 2 == 0)
    return even.select("l_orderkey", "l_linenumber", "l_partkey", F.pow(quantity, F.lit(2)).cast("long").alias("squared"))


@query(
    "rdd_flatmap",
    "SELECT conv_id, turn, unnest(string_split_regex(lower(text), '\\s+')) AS word FROM conversations",
)
def rdd_flatmap(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "conversations").select("conv_id", "turn", word_rows(F.col("text")))


@query("partition_sizes", "SELECT count(*) AS rows, true AS has_partitions, true AS is_even FROM lineitem")
def partition_sizes_query(spark: SparkSession, d: str) -> DataFrame:
    """All rows, and that a round-robin deal leaves partitions of nearly one size."""
    parts = spark.sparkContext.defaultParallelism
    sizes = partition_sizes(load(spark, d, "lineitem").repartition(parts))
    return sizes.agg(
        F.sum("rows").alias("rows"),
        (F.count(F.lit(1)) > 0).alias("has_partitions"),
        # each task that deals starts anew, so they may differ by its number
        (F.max("rows") - F.min("rows") <= F.greatest(F.lit(64), F.max("rows") * 0.1)).alias("is_even"),
    )


@query("keys_per_partition", "SELECT DISTINCT l_suppkey, CAST(1 AS bigint) AS partitions FROM lineitem")
def keys_per_partition_query(spark: SparkSession, d: str) -> DataFrame:
    """After a deal by key every key lies in one partition."""
    parts = spark.sparkContext.defaultParallelism
    return keys_per_partition(load(spark, d, "lineitem").select("l_suppkey").repartition(parts, "l_suppkey"), "l_suppkey")


@query("sort_within_partitions", "SELECT count(*) AS rows, CAST(0 AS bigint) AS out_of_order FROM orders")
def sort_within_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Rows that follow a greater one inside their partition after a sort within partitions: none."""
    orders = load(spark, d, "orders").select("o_custkey", "o_orderkey")
    placed = sort_within(orders, spark.sparkContext.defaultParallelism, "o_custkey", "o_custkey", "o_orderkey").select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    )
    before = F.lag(F.struct("o_custkey", "o_orderkey")).over(Window.partitionBy("part", "o_custkey").orderBy("at"))
    return placed.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("before") > F.struct("o_custkey", "o_orderkey")).alias("out_of_order"),
    )


@query(
    "schema_frame",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS int) AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null_rows FROM orders"
        for i, (c, t) in enumerate(
            [
                ("o_orderkey", "bigint"),
                ("o_custkey", "bigint"),
                ("o_orderstatus", "string"),
                ("o_totalprice", "double"),
                ("o_orderdate", "timestamp_ntz"),
                ("o_orderpriority", "string"),
            ]
        )
    ),
)
def schema_frame_query(spark: SparkSession, d: str) -> DataFrame:
    return schema_frame(load(spark, d, "orders"))
