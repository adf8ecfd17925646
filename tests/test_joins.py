"""Join kinds on a pair with unmatched rows, NULL keys and duplicate keys."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwell.operators.joins import (
    broadcast_if_small,
    estimated_bytes,
    filter_by_match,
    key_salts,
    key_skew,
    salted_join,
)
from loomwell.operators.layout import plan_text
from loomwell.plans.join_queries import join_skewed_baseline


@pytest.fixture(scope="module")
def pair(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "d"), (None, "e")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (7, "w"), (None, "n")], "k int, r string")
    return left, right


EXPECTED = {
    "inner": {("a", "x"), ("b", "x"), ("c", "y"), ("c", "z")},
    "left": {("a", "x"), ("b", "x"), ("c", "y"), ("c", "z"), ("d", None), ("e", None)},
    "right": {("a", "x"), ("b", "x"), ("c", "y"), ("c", "z"), (None, "w"), (None, "n")},
    "full": {("a", "x"), ("b", "x"), ("c", "y"), ("c", "z"), ("d", None), ("e", None), (None, "w"), (None, "n")},
}


@pytest.mark.parametrize("how", EXPECTED)
def test_plain_kinds(pair, how):
    left, right = pair
    joined = left.join(right, "k", how)
    assert {tuple(r) for r in joined.select("l", "r").collect()} == EXPECTED[how]


@pytest.mark.parametrize("how,kept", [("left_semi", {"a", "b", "c"}), ("left_anti", {"d", "e"})])
def test_filtering_kinds(pair, how, kept):
    left, right = pair
    for joined in (
        left.join(right, "k", how),
        salted_join(left, right, ["k"], how),
        salted_join(left, right, ["k"], how, rows_per_task=1),
        filter_by_match(left, right, "k", "k", anti=how == "left_anti"),
    ):
        assert {r["l"] for r in joined.collect()} == kept


@pytest.mark.parametrize("how", ["right", "full"])
def test_salting_refuses_kinds_that_would_repeat_rows(pair, how):
    with pytest.raises(ValueError):
        salted_join(*pair, ["k"], how)


keys = st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=1, max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lk=keys, rk=keys, n=st.integers(1, 5), how=st.sampled_from(["inner", "left"]))
def test_salted_equals_plain_for_any_keys(spark, lk, rk, n, how):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(lk)], "k int, l int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(rk)], "k int, r int")
    plain = sorted(left.join(right, "k", how).collect(), key=repr)
    assert sorted(salted_join(left, right, ["k"], how, rows_per_task=n).collect(), key=repr) == plain


def test_salting_spreads_the_hot_key(spark):
    facts = spark.range(20000).select(
        F.when(F.col("id") % 100 < 99, 1).otherwise(F.col("id") % 100).cast("long").alias("k"), "id"
    )
    dims = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))

    def largest(df):
        sizes = df.groupBy(F.spark_partition_id()).count()
        return sizes.agg(F.max("count")).first()[0]

    conf = "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"
    before = [spark.conf.get(c) for c in conf]
    spark.conf.set(conf[0], "false")
    spark.conf.set(conf[1], "-1")
    try:
        plain = largest(facts.join(dims, "k"))
        spread = salted_join(facts, dims, ["k"], row_key=["id"], rows_per_task=50)
        mean = spread.count() / int(spark.conf.get("spark.sql.shuffle.partitions"))
        salted = largest(spread)
    finally:
        for c, v in zip(conf, before):
            spark.conf.set(c, v)
    assert plain > 19000
    assert salted < 2 * mean


def test_salts_follow_the_rows(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in key_salts(df, ["k"], 30).collect()] == [(0, 14)]
    top = key_skew(df, ["k"]).orderBy(F.desc("rows")).first()
    assert (top["rows"], top["share"]) == (400, 0.4)


def test_broadcast_only_below_the_limit(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    assert estimated_bytes(orders) > 1000
    hinted = broadcast_if_small(orders)._jdf.queryExecution().logical().toString()
    plain = broadcast_if_small(orders, max_bytes=1000)._jdf.queryExecution().logical().toString()
    assert "Hint" in hinted and "Hint" not in plain


def test_rows_of_the_hot_key_are_not_sorted(spark, tmp_path, rows):
    """The plain skewed join holds the customers in memory, not the orders of one of them."""
    orders = [(k, k if k % 7 else None, 10.25) for k in range(1, 400)] + [(500, 50_001, 3.5), (501, 99, 1.0), (501, 99, 1.0)]
    customers = [(1, "A"), (1, "A"), (99, "B"), (299, None), (None, "C")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    joined = join_skewed_baseline(spark, str(tmp_path))
    text = plan_text(joined, "simple")
    assert "ShuffledHashJoin" in text and "Sort" not in text and "Broadcast" not in text
    hot = [(1 if c % 100 < 99 else c, price) for _, c, price in orders if c is not None]
    expected = {}
    for key, price in hot:
        for c, segment in customers:
            if c == key:
                n, total = expected.get(segment, (0, 0.0))
                expected[segment] = (n + 1, total + price)
    assert rows(joined) == sorted(((s, n, t) for s, (n, t) in expected.items()), key=repr)
