"""Scans, file round trips, partitioned layouts and generated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.operators.joins import broadcast_if_small
from loomwell.operators.layout import write_clustered
from loomwell.plans.registry import query
from loomwell.session import scratch_path
from loomwell.sources import files
from loomwell.sources.generate import generate_orders, key_spine
from loomwell.sources.tables import CUSTOMER, EVENTS, ORDERS, load


@query(
    "src_range_modkey",
    """
    WITH spine AS (SELECT unnest(range((SELECT max(o_orderkey) + 1 FROM orders))) AS id)
    SELECT CAST(id % 10 AS int) AS mod_key, count(*) AS slots, count(o_orderkey) AS orders_found,
           CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS total
    FROM spine LEFT JOIN orders ON id = o_orderkey GROUP BY 1
    """,
)
def src_range_modkey(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    spine = key_spine(orders, "o_orderkey")
    joined = spine.join(orders.select("o_orderkey", "o_totalprice", F.lit(1).alias("found")), "o_orderkey", "left")
    return joined.groupBy((F.col("o_orderkey") % 10).cast("int").alias("mod_key")).agg(
        F.count(F.lit(1)).alias("slots"),
        F.count("found").alias("orders_found"),
        F.sum(money("o_totalprice")).cast("double").alias("total"),
    )


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders")


@query("scan_column_prune", "SELECT o_orderkey, o_totalprice FROM orders")
def scan_column_prune(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select("o_orderkey", "o_totalprice")


@query(
    "scan_filter_pushdown",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R' AND l_quantity < 10
    """,
)
def scan_filter_pushdown(spark: SparkSession, d: str) -> DataFrame:
    return (
        load(spark, d, "lineitem")
        .filter(
            (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
            & (F.col("l_returnflag") == "R")
            & (F.col("l_quantity") < 10)
        )
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    )


@query("io_csv_infer_roundtrip", "SELECT * FROM customer")
def io_csv_infer_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv-infer")
    files.write_csv(load(spark, d, "customer"), path)
    read = files.read_csv(spark, path)
    # inference picks the narrowest integer that fits the data
    return read.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("io_csv_schema_roundtrip", "SELECT * FROM orders")
def io_csv_schema_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv-schema")
    files.write_csv(load(spark, d, "orders"), path)
    return files.read_csv(spark, path, ORDERS)


@query("io_json_roundtrip", "SELECT * FROM events")
def io_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "json")
    files.write_json(load(spark, d, "events"), path)
    return files.read_json(spark, path, EVENTS)


@query("io_parquet_roundtrip", "SELECT * FROM part")
def io_parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    load(spark, d, "part").write.parquet(path)
    return spark.read.parquet(path)


@query("io_orc_roundtrip", "SELECT * FROM customer")
def io_orc_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "orc")
    load(spark, d, "customer").write.orc(path)
    return spark.read.schema(CUSTOMER).orc(path)


@query(
    "io_append_doubles",
    "SELECT c_mktsegment, 2 * count(*) AS rows_after_append, count(DISTINCT c_custkey) AS customers FROM customer GROUP BY 1",
)
def io_append_doubles(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "append")
    customers = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    customers.write.mode("overwrite").parquet(path)
    customers.write.mode("append").parquet(path)
    return (
        spark.read.parquet(path)
        .groupBy("c_mktsegment")
        .agg(F.count(F.lit(1)).alias("rows_after_append"), F.count_distinct("c_custkey").alias("customers"))
    )


@query(
    "io_partition_prune_one",
    """
    SELECT o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS total
    FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1
    """,
)
def io_partition_prune_one(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "by-priority")
    files.write_partitioned(load(spark, d, "orders"), path, ["o_orderpriority"])
    return (
        spark.read.parquet(path)
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).cast("double").alias("total"))
    )


def orders_by_month(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "by-month")
    dated = load(spark, d, "orders").withColumns(
        {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    )
    files.write_partitioned(dated, path, ["year", "month"])
    return path


@query(
    "io_partition_prune_two",
    """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS int) AS year, CAST(month(o_orderdate) AS int) AS month
    FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 6
    """,
)
def io_partition_prune_two(spark: SparkSession, d: str) -> DataFrame:
    return (
        spark.read.parquet(orders_by_month(spark, d))
        .filter((F.col("year") == 1998) & (F.col("month") == 6))
        .select("o_orderkey", "o_totalprice", "year", "month")
    )


@query(
    "io_merge_schema",
    """
    SELECT o_orderkey, o_custkey, o_totalprice,
           CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderpriority END AS o_orderpriority
    FROM orders
    """,
)
def io_merge_schema(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "merge-schema")
    orders = load(spark, d, "orders")
    late = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    base = ["o_orderkey", "o_custkey", "o_totalprice"]
    orders.filter(~late).select(*base).write.parquet(f"{path}/batch=1")
    orders.filter(late).select(*base, "o_orderpriority").write.parquet(f"{path}/batch=2")
    return files.read_merged(spark, path).select(*base, "o_orderpriority")


@query(
    "io_file_layout",
    "SELECT o_orderstatus, count(*) AS rows, true AS has_files, true AS has_bytes FROM orders GROUP BY 1",
)
def io_file_layout(spark: SparkSession, d: str) -> DataFrame:
    """Rows per folder, and that each folder has files and bytes; their numbers depend on the cluster."""
    path = scratch_path(spark, "layout")
    files.write_partitioned(load(spark, d, "orders"), path, ["o_orderstatus"])
    table = spark.read.parquet(path)
    layout = files.file_layout(table, ["o_orderstatus"]).groupBy("o_orderstatus").agg(
        (F.sum("files") > 0).alias("has_files"), (F.sum("bytes") > 0).alias("has_bytes")
    )
    return table.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows")).join(layout, "o_orderstatus")


@query(
    "gen_orders",
    """
    WITH n AS (SELECT c_custkey, c_custkey * 3 + seq AS order_no
               FROM customer, (VALUES (0), (1), (2)) s(seq)),
         m AS (SELECT *, (order_no * 7919) % 100003 AS mixed FROM n)
    SELECT 'ORD-' || CAST(order_no AS varchar) AS order_id, c_custkey AS customer_id,
           ['Electronics', 'Clothing', 'Food', 'Sports', 'Home', 'Books'][CAST(mixed % 6 AS int) + 1] AS category,
           CAST(mixed % 10 + 1 AS int) AS quantity,
           CAST((mixed * 31) % 50000 + 500 AS double) / 100 AS amount,
           CAST(DATE '2023-01-01' + CAST(mixed % 730 AS int) AS date) AS order_date
    FROM m
    """,
)
def gen_orders(spark: SparkSession, d: str) -> DataFrame:
    return generate_orders(load(spark, d, "customer"), "c_custkey", 3)


@query(
    "io_clustered_scan",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem
    WHERE l_partkey BETWEEN (SELECT max(l_partkey) // 2 FROM lineitem) AND (SELECT max(l_partkey) // 2 + max(l_partkey) // 20 FROM lineitem)
      AND l_orderkey <= (SELECT max(l_orderkey) // 10 FROM lineitem)
    """,
)
def io_clustered_scan(spark: SparkSession, d: str) -> DataFrame:
    """Files clustered by two columns, so that a filter on both skips most row groups."""
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    top = lines.agg(F.max("l_partkey").alias("part"), F.max("l_orderkey").alias("order")).first()
    path = scratch_path(spark, "clustered")
    write_clustered(lines, path, ["l_partkey", "l_orderkey"], files=16)
    half = (top["part"] or 0) // 2
    wanted = F.col("l_partkey").between(half, half + (top["part"] or 0) // 20) & (F.col("l_orderkey") <= (top["order"] or 0) // 10)
    return spark.read.schema(lines.schema).parquet(path).filter(wanted)


@query(
    "io_dynamic_prune",
    """
    SELECT c_custkey, c_acctbal, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
    """,
)
def io_dynamic_prune(spark: SparkSession, d: str) -> DataFrame:
    """Customers stored by nation; which nations are read is known only once the joined dimension is."""
    path = scratch_path(spark, "by-nation")
    files.write_partitioned(load(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey"), path, ["c_nationkey"])
    asia = load(spark, d, "region").filter("r_name = 'ASIA'")
    nations = load(spark, d, "nation").join(broadcast_if_small(asia), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = spark.read.parquet(path).join(broadcast_if_small(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "c_acctbal", "n_name")
