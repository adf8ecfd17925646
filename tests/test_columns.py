"""Golden rows for nulls, strings, tiers, arrays, the cleaning job and Python functions."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomwell.functions import udfs
from loomwell.functions.numbers import price_tier
from loomwell.functions.text import normalise_name
from loomwell.operators.reshape import deduplicate
from loomwell.operators.windows import with_zscore
from loomwell.plans.jobs import clean_orders, monthly_summary, word_count

MESSY = [("  GARDEN hose ", "Garden Hose"), ("steel_water_jug", "Steel Water Jug"), ("Desk-LAMP", "Desk Lamp"), (None, None)]


@pytest.mark.parametrize(
    "function",
    [normalise_name, udfs.normalise_name_udf, udfs.normalise_name_pandas, udfs.normalise_name_batches],
)
def test_names_by_every_route(spark, function):
    df = spark.createDataFrame([(m,) for m, _ in MESSY], "raw string")
    assert [r["n"] for r in df.select(function(F.col("raw")).alias("n")).collect()] == [c for _, c in MESSY]


def test_price_tier_bounds(spark):
    cases = [(None, None), (-1.0, None), (0.0, None), (0.01, "budget"), (100.0, "budget"), (100.01, "mid-range"),
             (500.0, "mid-range"), (500.01, "premium"), (9e9, "premium")]
    df = spark.createDataFrame([(p,) for p, _ in cases], "p double")
    built_in, pandas = price_tier(F.col("p")), udfs.price_tier_pandas("p")
    assert [tuple(r) for r in df.select(built_in, pandas).collect()] == [(t, t) for _, t in cases]


def test_grouped_map_equals_window_form(spark, rows):
    df = spark.range(200).select("id", (F.col("id") % 3).alias("k"), (F.col("id") * 37 % 101).cast("double").alias("x"))
    python = udfs.group_zscore(df, ["k"], "id", "x", "z", chunk_rows=10)
    assert rows(python, "id", "z") == rows(with_zscore(df, ["k"], "x", "z"), "id", "z")
    single = udfs.group_zscore(df.filter("id = 5"), ["k"], "id", "x", "z", chunk_rows=10)
    assert single.first()["z"] is None


def test_null_handling(spark, rows):
    df = spark.createDataFrame([(" a ", 1.0), (None, 2.0), ("b", None)], "s string, x double")
    assert rows(df.fillna({"s": "?", "x": 0.0})) == [(" a ", 1.0), ("?", 2.0), ("b", 0.0)]
    assert rows(df.dropna(subset=["x"])) == sorted([(" a ", 1.0), (None, 2.0)], key=repr)
    assert rows(df.replace({"b": "B"}, subset=["s"]).filter("s = 'B'")) == [("B", None)]
    assert df.filter(F.col("s").isNotNull()).count() == 2
    assert df.select(F.trim("s")).first()[0] == "a"


def test_explode_drops_and_outer_keeps(spark, rows):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "id int, tags array<string>")
    assert rows(df.select("id", F.explode("tags"))) == [(1, "x"), (1, "y")]
    assert rows(df.select("id", F.explode_outer("tags"))) == [(1, "x"), (1, "y"), (2, None), (3, None)]
    assert rows(df.select("id", F.array_contains("tags", "x"))) == [(1, True), (2, False), (3, None)]


def test_deduplicate_keeps_the_first_in_order(spark, rows):
    df = spark.createDataFrame([(1, 5), (1, 3), (2, 9), (None, 1), (None, 0)], "k int, v int")
    assert rows(deduplicate(df, ["k"], [F.asc("v")])) == sorted([(1, 3), (2, 9), (None, 0)], key=repr)
    assert df.dropDuplicates(["k"]).count() == 3


def test_dirty_orders_are_cleaned(spark):
    raw = spark.createDataFrame(
        [
            ("1", "c1", " lamp ", " home ", "100", "2024-02-03"),
            ("2", "c1", "x", "home", "oops", "2024-02-03"),
            ("3", "c2", "x", "toys", "-5", "2024-02-03"),
            ("4", "c2", "x", "toys", None, "2024-02-03"),
            ("5", None, "x", "toys", "5", "2024-02-03"),
            ("6", "c3", "x", "toys", " 10.10 ", "not a day"),
        ],
        "order_id string, customer_id string, product string, category string, amount string, order_date string",
    )
    clean = {r["order_id"]: r for r in clean_orders(raw).collect()}
    assert sorted(clean) == ["1", "6"]
    first = clean["1"]
    assert (first["product"], first["category"]) == ("lamp", "HOME")
    assert (float(first["tax"]), float(first["total_amount"]), first["year"], first["month"]) == (18.0, 118.0, 2024, 2)
    assert clean["6"]["order_date"] is None and float(clean["6"]["tax"]) == 1.82
    summary = {r["category"]: r for r in monthly_summary(clean_orders(raw)).collect()}
    assert (summary["HOME"]["order_count"], float(summary["HOME"]["total_revenue"])) == (1, 118.0)


def test_word_count(spark, rows):
    df = spark.createDataFrame([("The cat  the\tDOG",), (" the",), ("",)], ["t"])
    assert rows(word_count(df, "t")) == [("cat", 1), ("dog", 1), ("the", 3)]


def test_pandas_on_spark_group_mean(spark):
    import pyspark.pandas as ps

    frame = ps.DataFrame(pd.DataFrame({"k": ["a", "a", "b"], "x": [1.0, 3.0, 5.0]}))
    assert frame.groupby("k")["x"].mean().to_pandas().to_dict() == {"a": 2.0, "b": 5.0}


def test_current_timestamp_and_seeded_rand(spark):
    assert spark.range(1).select(F.current_timestamp() > F.lit("2024-01-01").cast("timestamp")).first()[0]
    draws = [spark.range(50, numPartitions=2).select(F.rand(3)).collect() for _ in range(2)]
    assert draws[0] == draws[1]


def test_bad_column_fails_at_analysis(spark, sf):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        spark.read.parquet(f"{sf}/customer.parquet").select("c_acctball")
