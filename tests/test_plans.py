"""What the physical plans must look like, and partition and cache behaviour."""

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from loomwell.operators import layout as L
from loomwell.operators.windows import top_n_per_group, with_group_stats
from loomwell.operators.joins import filter_by_match, product_of_small, runtime_filter_session
from loomwell.plans.catalogue import REGISTRY
from loomwell.plans.io_queries import orders_by_month
from loomwell.plans.sql_queries import NATION_LINES, cost_based_session, measured_tables
from loomwell.session import scratch_path, shared_root
from loomwell.sources.tables import load

QUERIES = {name: item.run for name, item in REGISTRY.items()}


def plan(spark, sf, name):
    return L.plan_text(QUERIES[name](spark, sf))


def test_filter_reaches_the_scan(spark, sf):
    text = plan(spark, sf, "scan_filter_pushdown")
    assert "GreaterThanOrEqual(l_shipdate" in text and "EqualTo(l_returnflag,R)" in text and "LessThan(l_quantity" in text
    assert "l_comment" not in text and "l_tax" not in text


def test_columns_are_pruned(spark, sf):
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan(spark, sf, "scan_column_prune")
    text = plan(spark, sf, "join_pruned")
    assert "l_extendedprice" not in text and "c_acctbal" not in text


def test_partitions_are_pruned(spark, sf):
    read = spark.read.parquet(orders_by_month(spark, sf)).filter("year = 1998 AND month = 6")
    text = L.plan_text(read, "simple")
    assert "PartitionFilters: [isnotnull(year" in text and "PushedFilters: []" in text and "Filter (" not in text


def test_filter_before_and_after_join_give_one_plan(spark, sf):
    def shape(name):
        joined = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        return [line.strip(" :+-").split(" ")[0] for line in joined.splitlines()]

    assert shape("join_filter_after") == shape("join_filter_before")
    assert "GreaterThan(o_totalprice,300000.0)" in plan(spark, sf, "join_filter_after")


def test_join_strategies_follow_the_hints(spark, sf):
    assert "BroadcastHashJoin" in plan(spark, sf, "join_broadcast")
    assert "SortMergeJoin" in plan(spark, sf, "join_sort_merge")


def test_top_n_is_cut_before_the_shuffle(spark, sf):
    orders = load(spark, sf, "orders")
    text = L.plan_text(top_n_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3), "simple")
    partial = text.index("Partial") if "Partial" in text else -1
    assert text.count("WindowGroupLimit") == 2 and partial > text.index("Exchange")


def test_top_k_needs_no_full_sort(spark, sf):
    for name in ("limit_ordered", "topk_words"):
        assert "TakeOrderedAndProject" in plan(spark, sf, name)


def test_aggregation_is_partial_then_final(spark, sf):
    text = L.plan_text(QUERIES["agg_group_count"](spark, sf), "simple")
    assert "partial_count" in text and L.exchange_count(QUERIES["agg_group_count"](spark, sf)) == 1


@pytest.mark.parametrize("build", ["stats", "semi"])
def test_a_hot_key_is_split(spark, build):
    """95 % of the rows on one key and no broadcast: adaptive execution must split its partition."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 20 > 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        if build == "stats":
            joined = with_group_stats(rows, ["k"], {"n": F.count(F.lit(1))})
        else:
            joined = filter_by_match(rows, spark.range(100).withColumnRenamed("id", "m"), "k", "m")
        joined = joined.select("k", F.length("x").alias("x"))
        joined.collect()
        assert "skew=true" in L.plan_text(joined, "simple")
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_constant_folding(spark, sf):
    text = L.plan_text(load(spark, sf, "orders").filter("1 + 1 = 3"), "extended")
    assert "LocalRelation <empty>" in text.split("Optimized Logical Plan")[1]


# these run jobs when they are built, and what they return is a plain scan
EAGER = ("stream_", "pipe_stream", "io_", "ver_i", "ver_b", "ver_schema", "pipe_upsert", "pipe_etl_load", "sql_cost")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(EAGER)))
def test_no_cross_product_and_no_row_python(name, spark, sf):
    text = L.plan_text(QUERIES[name](spark, sf), "simple")
    if name == "join_product":  # of two tables whose size is checked
        return
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_repartition_coalesce_and_keys(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 17)
    assert df.repartition(6).rdd.getNumPartitions() == 6
    assert df.repartition(6).coalesce(2).rdd.getNumPartitions() == 2
    sizes = [r["rows"] for r in L.partition_sizes(df.repartition(4)).collect()]
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) < 60
    assert L.keys_per_partition(df.repartition(5, "k"), "k").agg(F.max("partitions")).first()[0] == 1
    assert L.keys_per_partition(df.repartition(5), "k").agg(F.max("partitions")).first()[0] > 1


def test_sort_within_partitions(spark):
    df = L.sort_within(spark.range(500).withColumn("k", F.col("id") % 7), 3, "k", "k", "id")
    parts = df.select(F.spark_partition_id().alias("p"), "k", "id").collect()
    by_part = {}
    for r in parts:
        by_part.setdefault(r["p"], []).append((r["k"], r["id"]))
    assert all(rows == sorted(rows) for rows in by_part.values())


def test_cache_levels(spark):
    for level in (StorageLevel.MEMORY_AND_DISK, StorageLevel.DISK_ONLY, StorageLevel.MEMORY_ONLY_2):
        base = spark.range(100)
        with L.persisted(base, level) as held:
            assert held.count() == 100 and held.storageLevel == level
            assert "InMemoryTableScan" in L.plan_text(held.filter("id > 5"))
        assert not base.is_cached


def test_catalog_cache_by_name(spark):
    spark.range(10).createOrReplaceTempView("ten")
    spark.catalog.cacheTable("ten")
    assert spark.catalog.isCached("ten")
    spark.catalog.uncacheTable("ten")
    assert not spark.catalog.isCached("ten")
    spark.catalog.cacheTable("ten")
    spark.catalog.clearCache()
    assert not spark.catalog.isCached("ten")


def test_catalog_frame(spark):
    spark.range(1).createOrReplaceTempView("one_column")
    found = L.catalog_frame(spark).filter("table_name = 'one_column'").collect()
    assert [(r["column_name"], r["data_type"]) for r in found] == [("id", "bigint")]


def test_reliable_checkpoint_cuts_lineage(spark):
    shared_root(spark)
    df = spark.range(100).withColumn("k", F.col("id") % 3).groupBy("k").count()
    cut = df.checkpoint()
    assert "Exchange" not in L.plan_text(cut, "simple").replace("ExistingRDD", "")
    assert sorted(r["count"] for r in cut.collect()) == [33, 33, 34]


def test_table_statistics(spark, tmp_path):
    path = scratch_path(spark, "stats-table")
    spark.range(42).write.option("path", path).mode("overwrite").saveAsTable("counted")
    try:
        spark.sql("ANALYZE TABLE counted COMPUTE STATISTICS")
        detail = spark.sql("DESCRIBE EXTENDED counted").filter("col_name = 'Statistics'").first()
        assert "42 rows" in detail["data_type"]
    finally:
        spark.sql("DROP TABLE counted")


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_product_of_small_tables(spark):
    left, right = spark.range(30), spark.range(4).withColumnRenamed("id", "other")
    assert product_of_small(left, right).count() == 120
    assert product_of_small(left.limit(0), right).count() == 0
    for pair in ((left, right), (right, left)):
        with pytest.raises(ValueError):
            product_of_small(*pair, max_rows=29)
    assert product_of_small(left, right, max_rows=30).count() == 120


@pytest.mark.parametrize("name", ["join_bloom_filtered", "join_bloom_no_match"])
def test_bloom_filter_in_the_scan(spark, sf, name):
    df = QUERIES[name](spark, sf)
    text = L.plan_text(df, "simple")
    assert "might_contain" in text and "bloom_filter_agg" in text and "SortMergeJoin" in text
    assert text.index("SortMergeJoin") < text.index("might_contain")
    assert (df.count() == 0) == (name == "join_bloom_no_match")


def test_bloom_filter_keeps_every_match(spark, tmp_path):
    session = runtime_filter_session(spark)
    session.range(20_000).withColumn("x", F.col("id") % 50).write.parquet(f"{tmp_path}/large")
    session.range(0, 20_000, 3).withColumn("y", F.col("id") % 100).write.parquet(f"{tmp_path}/small")
    large, small = session.read.parquet(f"{tmp_path}/large"), session.read.parquet(f"{tmp_path}/small").filter("y = 7")
    joined = large.join(small, "id")
    assert "might_contain" in L.plan_text(joined, "simple")
    assert joined.count() == small.count() > 0


def test_statistics_turn_the_join_order_round(spark, sf):
    names = measured_tables(spark, sf)
    text = NATION_LINES.format(**names)

    def first_read(session):
        plan = L.plan_text(session.sql(text), "extended").split("Optimized Logical Plan")[1].split("Physical Plan")[0]
        # the deepest join is printed last; its inputs are what is joined first
        depth = {t: max(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Relation" in line and n.split("_")[1] in line) for t, n in names.items()}
        return max(depth, key=depth.get), plan

    plain = spark.newSession()
    plain.conf.set("spark.sql.cbo.enabled", False)
    (before, as_written), (after, by_cost) = first_read(plain), first_read(cost_based_session(spark))
    assert before in ("lineitem", "orders") and after in ("customer", "nation"), (as_written, by_cost)
    assert sorted(map(tuple, plain.sql(text).collect())) == sorted(map(tuple, cost_based_session(spark).sql(text).collect()))
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


def test_clustered_files_are_skipped(spark, tmp_path):
    df = spark.range(200_000).select((F.pmod(F.col("id") * 7919, F.lit(1000))).alias("a"), (F.pmod(F.col("id") * 104729, F.lit(997))).alias("b"), "id")
    L.write_clustered(df, f"{tmp_path}/curve", ["a", "b"], files=64)
    df.repartitionByRange(64, "a").write.parquet(f"{tmp_path}/sorted")
    for condition, most in (("a BETWEEN 400 AND 420", 0.3), ("b BETWEEN 400 AND 420", 0.3), ("a < 60 AND b < 60", 0.1)):
        found = spark.read.parquet(f"{tmp_path}/curve").filter(condition)
        assert sorted(found.toPandas()["id"]) == sorted(df.filter(condition).toPandas()["id"])
        assert sum(L.scan_rows(found)) < most * 200_000
    one = spark.read.parquet(f"{tmp_path}/sorted").filter("b BETWEEN 400 AND 420")
    assert len(one.toPandas()) and sum(L.scan_rows(one)) > 0.9 * 200_000
    with pytest.raises(ValueError):
        L.curve_place(df, ["a", "b", "id"], bits=21)


def test_curve_of_nulls_constants_and_nothing(spark):
    df = spark.createDataFrame([(None, 1), (5, 1), (-5, 1), (0, 1)], "a int, b int")
    order = [r["a"] for r in df.withColumn("p", L.curve_place(df, ["a", "b"])).orderBy("p", F.col("a").isNotNull()).collect()]
    assert order == [None, -5, 0, 5]
    assert df.limit(0).withColumn("p", L.curve_place(df.limit(0), ["a"])).count() == 0


def test_a_joined_dimension_prunes_partitions(spark, sf):
    df = QUERIES["io_dynamic_prune"](spark, sf)
    assert "dynamicpruning" in L.plan_text(df, "simple")
    rows = df.collect()
    total = load(spark, sf, "customer").count()
    assert len(rows) < total and max(L.scan_rows(df)) <= max(len(rows), 25)
