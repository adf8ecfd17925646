"""Ranking, neighbours, frames and top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.operators import windows as W
from loomwell.plans.jobs import best_orders_per_group
from loomwell.plans.registry import query
from loomwell.sources.tables import load

BY_CUSTOMER = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"


def in_order() -> list:
    return [F.asc("o_orderdate"), F.asc("o_orderkey")]


def orders_of(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query("win_row_number", f"SELECT o_orderkey, o_custkey, row_number() {BY_CUSTOMER}) AS row_num FROM orders")
def win_row_number(spark: SparkSession, d: str) -> DataFrame:
    placed = W.with_position(orders_of(spark, d), ["o_custkey"], in_order(), "row_num")
    return placed.select("o_orderkey", "o_custkey", "row_num")


@query(
    "win_rank",
    """
    SELECT p_partkey, p_brand, p_size, CAST(rank() OVER w AS int) AS rank, CAST(dense_rank() OVER w AS int) AS dense_rank
    FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size DESC)
    """,
)
def win_rank(spark: SparkSession, d: str) -> DataFrame:
    ranked = W.with_ranks(load(spark, d, "part"), ["p_brand"], "p_size", percent=False)
    return ranked.select("p_partkey", "p_brand", "p_size", "rank", "dense_rank")


@query(
    "win_percent_rank",
    """
    SELECT p_partkey, p_brand, p_size, round(percent_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC), 3) AS pct
    FROM part
    """,
)
def win_percent_rank(spark: SparkSession, d: str) -> DataFrame:
    ranked = W.with_ranks(load(spark, d, "part"), ["p_brand"], "p_size")
    return ranked.select("p_partkey", "p_brand", "p_size", F.round("percent_rank", 3).alias("pct"))


@query(
    "win_ntile",
    f"""
    SELECT o_orderkey, o_custkey, CAST(ntile(4) {BY_CUSTOMER}) AS int) AS quartile, CAST(ntile(10) {BY_CUSTOMER}) AS int) AS decile
    FROM orders
    """,
)
def win_ntile(spark: SparkSession, d: str) -> DataFrame:
    tiled = W.with_ntile(orders_of(spark, d), ["o_custkey"], in_order(), {"quartile": 4, "decile": 10})
    return tiled.select("o_orderkey", "o_custkey", "quartile", "decile")


@query(
    "win_lag_lead",
    f"""
    SELECT o_orderkey, o_totalprice, lag(o_totalprice, 1) {BY_CUSTOMER}) AS prev_price,
           lead(o_totalprice, 1) {BY_CUSTOMER}) AS next_price, lag(o_totalprice, 1, 0.0) {BY_CUSTOMER}) AS prev_or_zero
    FROM orders
    """,
)
def win_lag_lead(spark: SparkSession, d: str) -> DataFrame:
    near = W.with_neighbours(
        orders_of(spark, d),
        ["o_custkey"],
        in_order(),
        lambda w: {
            "prev_price": F.lag("o_totalprice", 1).over(w),
            "next_price": F.lead("o_totalprice", 1).over(w),
            "prev_or_zero": F.lag("o_totalprice", 1, 0.0).over(w),
        },
        before=1,
        after=1,
    )
    return near.select("o_orderkey", "o_totalprice", "prev_price", "next_price", "prev_or_zero")


@query("win_lag2", "SELECT conv_id, turn, lag(role, 2) OVER (PARTITION BY conv_id ORDER BY turn) AS role_two_back FROM conversations")
def win_lag2(spark: SparkSession, d: str) -> DataFrame:
    turns = load(spark, d, "conversations").select("conv_id", "turn", "role")
    near = W.with_neighbours(
        turns, ["conv_id"], [F.asc("turn")], lambda w: {"role_two_back": F.lag("role", 2).over(w)}, before=2, after=0
    )
    return near.select("conv_id", "turn", "role_two_back")


@query(
    "win_delta_prev",
    f"""
    SELECT o_orderkey, CAST(CAST(o_totalprice AS decimal(18,2)) - lag(CAST(o_totalprice AS decimal(18,2))) {BY_CUSTOMER}) AS double) AS delta
    FROM orders
    """,
)
def win_delta_prev(spark: SparkSession, d: str) -> DataFrame:
    price = money("o_totalprice")
    near = W.with_neighbours(
        orders_of(spark, d),
        ["o_custkey"],
        in_order(),
        lambda w: {"delta": (price - F.lag(price).over(w)).cast("double")},
        before=1,
        after=0,
    )
    return near.select("o_orderkey", "delta")


@query(
    "win_days_to_next",
    f"""
    SELECT o_orderkey, CAST(CAST(lead(o_orderdate) {BY_CUSTOMER}) AS date) - CAST(o_orderdate AS date) AS int) AS days_to_next
    FROM orders
    """,
)
def win_days_to_next(spark: SparkSession, d: str) -> DataFrame:
    near = W.with_neighbours(
        orders_of(spark, d),
        ["o_custkey"],
        in_order(),
        lambda w: {"days_to_next": F.datediff(F.lead("o_orderdate").over(w), "o_orderdate")},
        before=0,
        after=1,
    )
    return near.select("o_orderkey", "days_to_next")


def frame_oracle(frame: str) -> str:
    over = f"{BY_CUSTOMER} {frame})"
    return f"""
    SELECT o_orderkey,
           CAST(sum(CAST(o_totalprice AS decimal(18,2))) {over} AS double) / count(*) {over} AS avg_price,
           min(o_totalprice) {over} AS min_price, max(o_totalprice) {over} AS max_price
    FROM orders
    """


def framed(spark: SparkSession, d: str, before: int, after: int) -> DataFrame:
    near = W.with_neighbours(
        orders_of(spark, d),
        ["o_custkey"],
        in_order(),
        lambda w: {
            "avg_price": F.sum(money("o_totalprice")).over(w.rowsBetween(-before, after)).cast("double")
            / F.count(F.lit(1)).over(w.rowsBetween(-before, after)),
            "min_price": F.min("o_totalprice").over(w.rowsBetween(-before, after)),
            "max_price": F.max("o_totalprice").over(w.rowsBetween(-before, after)),
        },
        before,
        after,
    )
    return near.select("o_orderkey", "avg_price", "min_price", "max_price")


@query("win_rolling3", frame_oracle("ROWS BETWEEN 2 PRECEDING AND CURRENT ROW"))
def win_rolling3(spark: SparkSession, d: str) -> DataFrame:
    return framed(spark, d, 2, 0)


@query("win_centered", frame_oracle("ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING"))
def win_centered(spark: SparkSession, d: str) -> DataFrame:
    return framed(spark, d, 1, 1)


def running_oracle(frame: str) -> str:
    over = f"{BY_CUSTOMER} {frame})"
    total = f"CAST(sum(CAST(o_totalprice AS decimal(18,2))) {over} AS double)"
    return f"""
    SELECT o_orderkey, {total} AS running_total, count(*) {over} AS running_count, {total} / count(*) {over} AS running_avg
    FROM orders
    """


def running(spark: SparkSession, d: str, order: list) -> DataFrame:
    totals = {"total": money("o_totalprice"), "running_count": F.lit(1)}
    summed = W.with_running_totals(orders_of(spark, d), ["o_custkey"], order, totals)
    total = F.col("total").cast("double")
    return summed.select(
        "o_orderkey", total.alias("running_total"), "running_count", (total / F.col("running_count")).alias("running_avg")
    )


@query("win_running", running_oracle("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"))
def win_running(spark: SparkSession, d: str) -> DataFrame:
    return running(spark, d, in_order())


@query("win_remaining", running_oracle("ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"))
def win_remaining(spark: SparkSession, d: str) -> DataFrame:
    # what remains from here on is a running total from the other end
    return running(spark, d, [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query(
    "win_share_of_total",
    """
    SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS decimal(18,2))) OVER w AS double) AS customer_total,
           round(o_totalprice / CAST(sum(CAST(o_totalprice AS decimal(18,2))) OVER w AS double) * 100, 4) AS pct
    FROM orders WINDOW w AS (PARTITION BY o_custkey)
    """,
)
def win_share_of_total(spark: SparkSession, d: str) -> DataFrame:
    stats = {"customer_total": F.sum(money("o_totalprice")).cast("double")}
    shared = W.with_group_stats(orders_of(spark, d), ["o_custkey"], stats)
    pct = F.round(F.col("o_totalprice") / F.col("customer_total") * 100, 4)
    return shared.select("o_orderkey", "customer_total", pct.alias("pct"))


@query(
    "win_global",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS overall_rank FROM orders",
)
def win_global(spark: SparkSession, d: str) -> DataFrame:
    by_price = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    placed = W.with_position(orders_of(spark, d), [], by_price, "overall_rank")
    return placed.select("o_orderkey", "overall_rank")


WEEK = 7 * 86400 * 1_000_000  # microseconds


@query(
    "win_range_7d",
    """
    SELECT event_id, CAST(sum(CAST(value AS decimal(18,2))) OVER w AS double) AS value_7d, count(*) OVER w AS events_7d
    FROM (SELECT *, epoch_us(ts) AS micros FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY micros RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW)
    """,
)
def win_range_7d(spark: SparkSession, d: str) -> DataFrame:
    events = load(spark, d, "events").select(
        "event_id", "user_id", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros")
    )
    totals = {"value_7d": money("value"), "events_7d": F.lit(1)}
    summed = W.with_range_totals(events, ["user_id"], "micros", WEEK, totals)
    return summed.select("event_id", F.col("value_7d").cast("double").alias("value_7d"), "events_7d")


@query(
    "win_range_nulls",
    """
    SELECT event_id, CAST(sum(v) OVER w AS double) AS value_7d
    FROM (SELECT event_id, user_id, CASE WHEN event_id % 3 > 0 THEN CAST(value AS decimal(18,2)) END AS v,
                 CASE WHEN event_id % 5 > 0 THEN epoch_us(ts) END AS micros FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY micros NULLS FIRST RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW)
    """,
)
def win_range_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Missing times see each other only; a frame without a value has no sum."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = load(spark, d, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 3 > 0, money("value")).alias("v"),
        F.when(F.col("event_id") % 5 > 0, micros).alias("micros"),
    )
    summed = W.with_range_totals(events, ["user_id"], "micros", WEEK, {"value_7d": F.col("v")})
    return summed.select("event_id", F.col("value_7d").cast("double").alias("value_7d"))


@query(
    "win_range_extremes",
    """
    SELECT event_id, min(value) OVER w AS least_7d, max(value) OVER w AS greatest_7d,
           max(event_type) OVER w AS last_type_7d
    FROM (SELECT *, epoch_us(ts) AS micros FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY micros RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW)
    """,
)
def win_range_extremes(spark: SparkSession, d: str) -> DataFrame:
    events = load(spark, d, "events").select(
        "event_id", "user_id", "value", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros")
    )
    least, greatest = {"least_7d": F.col("value")}, {"greatest_7d": F.col("value"), "last_type_7d": F.col("event_type")}
    framed = W.with_range_extremes(events, ["user_id"], "micros", WEEK, least, greatest)
    return framed.select("event_id", "least_7d", "greatest_7d", "last_type_7d")


@query(
    "win_range_extremes_ties",
    """
    SELECT o_orderkey, min(p) OVER w AS least, max(p) OVER w AS greatest
    FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS p,
                 CASE WHEN o_orderkey % 7 > 0 THEN date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS date)) END AS day FROM orders)
    WINDOW w AS (PARTITION BY o_orderstatus ORDER BY day NULLS FIRST RANGE BETWEEN 10 PRECEDING AND CURRENT ROW)
    """,
)
def win_range_extremes_ties(spark: SparkSession, d: str) -> DataFrame:
    """Three groups with all the rows, many of them on one day; missing days see each other only."""
    orders = load(spark, d, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("p"),
        F.when(F.col("o_orderkey") % 7 > 0, F.unix_date(F.col("o_orderdate").cast("date"))).alias("day"),
    )
    framed = W.with_range_extremes(orders, ["o_orderstatus"], "day", 10, {"least": F.col("p")}, {"greatest": F.col("p")})
    return framed.select("o_orderkey", "least", "greatest")


@query(
    "win_default_frame",
    "SELECT p_partkey, p_brand, p_size, CAST(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_size) AS bigint) AS size_so_far FROM part",
)
def win_default_frame(spark: SparkSession, d: str) -> DataFrame:
    parts = load(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return W.with_peer_totals(parts, ["p_brand"], "p_size", {"size_so_far": F.col("p_size")})


@query(
    "top1_per_group",
    """
    SELECT c_nationkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn = 1
    """,
)
def top1_per_group(spark: SparkSession, d: str) -> DataFrame:
    joined = load(spark, d, "orders").join(load(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    best = W.top_n_per_group(joined, ["c_nationkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 1)
    return best.select("c_nationkey", "o_orderkey", "o_totalprice")


@query(
    "top5_then_agg",
    """
    WITH r AS (SELECT c_nationkey, o_totalprice, rank() OVER (PARTITION BY c_nationkey ORDER BY o_totalprice DESC) AS rnk
               FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= 1000)
    SELECT c_nationkey, count(*) AS top_orders, CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS top_total,
           max(o_totalprice) AS largest
    FROM r WHERE rnk <= 5 GROUP BY 1
    """,
)
def top5_then_agg(spark: SparkSession, d: str) -> DataFrame:
    return best_orders_per_group(load(spark, d, "orders"), load(spark, d, "customer"), F.lit(1000), "c_nationkey", 5)


@query(
    "win_zscore",
    """
    SELECT o_orderkey, o_custkey, o_totalprice,
           CASE WHEN stddev_samp(o_totalprice) OVER w > 0
                THEN round((o_totalprice - avg(o_totalprice) OVER w) / stddev_samp(o_totalprice) OVER w, 3) END AS z
    FROM orders WINDOW w AS (PARTITION BY o_custkey)
    """,
)
def win_zscore(spark: SparkSession, d: str) -> DataFrame:
    scored = W.with_zscore(orders_of(spark, d), ["o_custkey"], "o_totalprice", "z")
    return scored.select("o_orderkey", "o_custkey", "o_totalprice", "z")
