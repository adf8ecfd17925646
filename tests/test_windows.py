"""Golden rows for rankings and frames, and the range route against Spark's own windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwell.operators import windows as W
from loomwell.operators.aggregates import (
    collect_in_chunks,
    collect_set_in_chunks,
    distinct_by_level,
    exact_quantiles,
    profile_text,
    quantiles_by_group,
    select_quantiles,
    summarise,
    with_dense_code,
)
from loomwell.operators.layout import plan_text
from loomwell.operators.ordering import in_ranges, range_count

SMALL = 7  # rows per task that cuts every group of the skewed fixture
MIXED = 60  # cuts only its hot group


CASES = pytest.mark.parametrize("keys,limit", [(["k"], SMALL), (["k"], MIXED), ([], SMALL)])
KEYED = pytest.mark.parametrize("limit", [SMALL, MIXED])


@pytest.fixture(scope="module")
def ties(spark):
    return spark.createDataFrame([("g", i, v) for i, v in enumerate([5, 4, 4, 3, 2])], "k string, id int, v int")


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with two thirds of the rows, a NULL key, small keys, and many ties."""
    rng = random.Random(7)
    data = []
    for i in range(300):
        key = "hot" if i % 3 else rng.choice(["a", "b", None, "c"])
        data.append((key, i, rng.randrange(12), rng.randrange(1000)))
    return spark.createDataFrame(data, "k string, id int, v int, w int").cache()


def test_rank_table(ties, rows):
    ranked = W.with_ranks(ties, ["k"], "v")
    assert rows(ranked, "id", "rank", "dense_rank", "percent_rank") == [
        (0, 1, 1, 0.0),
        (1, 2, 2, 0.25),
        (2, 2, 2, 0.25),
        (3, 4, 3, 0.75),
        (4, 5, 4, 1.0),
    ]


def test_ntile_gives_spare_rows_to_first_tiles(ties, rows):
    tiled = W.with_ntile(ties, ["k"], [F.desc("v"), F.asc("id")], {"t": 4})
    assert [r[1] for r in rows(tiled, "id", "t")] == [1, 1, 2, 3, 4]


def test_rolling_frame_ramps_up(ties, rows):
    near = W.with_neighbours(
        ties, ["k"], [F.asc("id")], lambda w: {"s": F.sum("v").over(w.rowsBetween(-2, 0))}, before=2, after=0
    )
    assert [r[1] for r in rows(near, "id", "s")] == [5, 9, 13, 11, 9]


def test_default_frame_shares_the_value_among_peers(ties, rows):
    summed = W.with_peer_totals(ties, ["k"], "v", {"s": F.col("v")})
    assert [r[1] for r in rows(summed, "id", "s")] == [18, 13, 13, 5, 2]


def test_top_n_with_and_without_ties(ties, skewed, rows):
    assert W.top_n_per_group(ties, ["k"], [F.desc("v"), F.asc("id")], 2).count() == 2
    assert rows(W.top_n_with_ties(ties, ["k"], "v", 2), "id", "rnk") == [(0, 1), (1, 2), (2, 2)]
    for n in (1, 4, 40):
        by_rank = W.with_ranks(skewed, ["k"], "v").filter(F.col("rank") <= n)
        assert rows(W.top_n_with_ties(skewed, ["k"], "v", n), "id", "rnk") == rows(by_rank, "id", "rank")


def test_ranges_grow_with_the_rows():
    assert [range_count(n, 100) for n in (0, 100, 1000, 10_000)] == [1, 1, 10, 100]
    assert [range_count(n, 250_000, cores=8) for n in (0, 20_000, 90_000, 10**6, 10**7)] == [1, 1, 5, 8, 40]


def test_only_groups_with_several_ranges_are_dealt_by_range(skewed):
    ranges = in_ranges(skewed, ["k"], [F.asc("id")], MIXED)
    assert {r["k"] for r in ranges.several.select("k").distinct().collect()} == {"hot"}
    assert ranges.rows.count() == 300 and ranges.several.count() == skewed.filter("k = 'hot'").count()
    most = ranges.several.groupBy("_range").count().agg(F.max("count")).first()[0]
    assert most < 2 * MIXED
    assert in_ranges(skewed, ["k"], [F.asc("id")], 1000).several is None


def native(keys, *order):
    return Window.partitionBy(*keys).orderBy(*order)


@CASES
def test_positions(skewed, rows, keys, limit):
    order = [F.desc("v"), F.asc("id")]
    plain = skewed.withColumn("position", F.row_number().over(native(keys, *order)))
    split = W.with_position(skewed, keys, order, rows_per_task=limit)
    assert rows(plain, "id", "position") == rows(split, "id", "position")


@CASES
def test_running_totals(skewed, rows, keys, limit):
    order = [F.asc("v"), F.asc("id")]
    totals = {"s": F.when(F.col("w") > 300, F.col("w")), "n": F.lit(1)}
    window = native(keys, *order).rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumns({n: F.sum(c).over(window) for n, c in totals.items()})
    split = W.with_running_totals(skewed, keys, order, totals, rows_per_task=limit)
    assert rows(plain, "id", "s", "n") == rows(split, "id", "s", "n")


@CASES
def test_ranks(skewed, rows, keys, limit):
    ranks = {"rank": F.rank(), "dense_rank": F.dense_rank(), "percent_rank": F.percent_rank()}
    plain = skewed.withColumns({n: c.over(native(keys, F.desc("v"))) for n, c in ranks.items()})
    assert rows(plain, "id", *ranks) == rows(W.with_ranks(skewed, keys, "v", rows_per_task=limit), "id", *ranks)


@CASES
def test_ntiles(skewed, rows, keys, limit):
    order, tiles = [F.asc("v"), F.desc("id")], {"t4": 4, "t10": 10, "t250": 250}
    plain = skewed.withColumns({n: F.ntile(t).over(native(keys, *order)) for n, t in tiles.items()})
    split = W.with_ntile(skewed, keys, order, tiles, rows_per_task=limit)
    assert rows(plain, "id", *tiles) == rows(split, "id", *tiles)


@CASES
def test_neighbours(skewed, rows, keys, limit):
    def build(w):
        return {
            "prev2": F.lag("w", 2).over(w),
            "next1": F.lead("w", 1).over(w),
            "low": F.min("w").over(w.rowsBetween(-2, 1)),
            "n": F.count(F.lit(1)).over(w.rowsBetween(-2, 1)),
        }

    order = [F.asc("v"), F.asc("id")]
    plain = skewed.withColumns(build(native(keys, *order)))
    split = W.with_neighbours(skewed, keys, order, build, 2, 1, rows_per_task=limit)
    columns = ["id", "prev2", "next1", "low", "n"]
    assert rows(plain, *columns) == rows(split, *columns)


def native_range(frame, measures):
    return {n: {"sum": F.sum, "min": F.min, "max": F.max}[k](c).over(frame) for n, (k, c) in measures.items()}


@KEYED
@pytest.mark.parametrize("width", [0, 1, 3, 50])
def test_range_frames_equal_the_native_frame_with_nulls(skewed, rows, limit, width):
    some = skewed.withColumns(
        {"v": F.when(F.col("id") % 4 > 0, F.col("v").cast("long") - 6), "w": F.when(F.col("id") % 3 > 0, F.col("w"))}
    )
    measures = {"s": ("sum", F.col("w")), "n": ("sum", F.lit(1)), "low": ("min", F.col("w")), "high": ("max", F.col("w"))}
    plain = some.withColumns(native_range(native(["k"], "v").rangeBetween(-width, 0), measures))
    split = W.with_range_frames(some, ["k"], "v", width, measures, rows_per_task=limit)
    assert rows(plain, "id", *measures) == rows(split, "id", *measures)


def test_range_frames_in_one_hot_block(spark, rows):
    """All rows of one key within one width, many of them peers, cut into many ranges."""
    df = spark.range(400).select(F.lit("k").alias("k"), "id", (F.pmod(F.col("id") * 37, F.lit(90)) - 45).alias("at"), F.pmod(F.col("id") * 101, F.lit(997)).alias("x"))
    measures = {"low": ("min", F.col("x")), "high": ("max", F.col("x")), "s": ("sum", F.col("x"))}
    plain = df.withColumns(native_range(native(["k"], "at").rangeBetween(-60, 0), measures))
    split = W.with_range_frames(df, ["k"], "at", 60, measures, rows_per_task=7)
    assert rows(plain, "id", *measures) == rows(split, "id", *measures)


def test_range_frames_of_nulls_alone_and_of_nothing(spark, rows):
    df = spark.createDataFrame([("a", 1, None, 5), ("a", 2, None, 7), ("a", 3, 4, None)], "k string, id int, t long, x int")
    assert rows(W.with_range_totals(df, ["k"], "t", 5, {"s": F.col("x")}), "id", "s") == [(1, 12), (2, 12), (3, None)]
    extremes = W.with_range_extremes(df, ["k"], "t", 5, {"low": F.col("x")}, {"high": F.col("x")})
    assert rows(extremes, "id", "low", "high") == [(1, 5, 7), (2, 5, 7), (3, None, None)]
    assert rows(W.with_range_extremes(df.limit(0), ["k"], "t", 5, {"low": F.col("x")}, {}), "id") == []
    with pytest.raises(ValueError):
        W.with_range_extremes(df, ["k"], "t", -1, {"low": F.col("x")}, {})


def test_the_input_is_worked_out_once(spark):
    """Counting, drawing range bounds and dealing read what the first of them kept."""
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for pdf in frames:
            seen.add(len(pdf))
            yield pdf

    df = spark.range(500).withColumn("k", F.col("id") % 3).mapInPandas(count, "id long, k long")
    placed = W.with_position(df, ["k"], [F.asc("id")], rows_per_task=50)
    assert placed.count() == 500 and seen.value == 500
    assert not df.storageLevel.useMemory


def test_a_frame_that_its_owner_keeps_stays_kept(skewed):
    W.with_position(skewed, ["k"], [F.asc("id")], rows_per_task=SMALL).count()
    assert skewed.storageLevel.useMemory


@KEYED
def test_peer_totals(skewed, rows, limit):
    plain = skewed.withColumn("s", F.sum("w").over(native(["k"], "v")))
    split = W.with_peer_totals(skewed, ["k"], "v", {"s": F.col("w")}, rows_per_task=limit)
    assert rows(plain, "id", "s") == rows(split, "id", "s")


def test_group_stats_keep_null_keys(skewed, rows):
    stats = W.with_group_stats(skewed, ["k"], {"n": F.count(F.lit(1))})
    assert stats.count() == 300
    sizes = dict(rows(skewed.groupBy("k").count()))
    assert all(n == sizes[k] for k, n in rows(stats, "k", "n"))


def test_zscore_undefined_for_single_and_constant_groups(spark, rows):
    df = spark.createDataFrame([("one", 1.0), ("same", 2.0), ("same", 2.0), ("ok", 1.0), ("ok", 3.0)], "k string, x double")
    scored = dict((k + str(x), z) for k, x, z in rows(W.with_zscore(df, ["k"], "x", "z")))
    assert scored == {"one1.0": None, "same2.0": None, "ok1.0": -0.707, "ok3.0": 0.707}


def test_exact_quantiles(skewed):
    shares = {"lo": 0.1, "mid": 0.5, "q": 0.75, "top": 1.0}
    plain = skewed.agg(*[F.percentile("w", F.lit(p)).alias(n) for n, p in shares.items()]).first()
    assert plain == exact_quantiles(skewed, "w", shares).first()


@pytest.mark.parametrize("bins", [200, 4096])
def test_quantiles_of_odd_columns_by_selection(spark, bins):
    """Extremes of the type, a long tail, ties, negatives, NULLs, a constant, one value, none, NaN and infinity."""
    rnd = random.Random(bins)
    table = [
        (
            rnd.choice((-1.0, 1.0)) * 10.0 ** rnd.randrange(-300, 308),
            1.7e308 if k % 2 else -1.7e308,
            rnd.choice((1, 1, 1, 2, 10**12)) if k % 3 else None,
            7,
            k if k == 5 else None,
            None,
            float("nan") if k > 150 else float(k),
            float("inf") if k > 190 else -float(k) if k else float("-inf"),
        )
        for k in range(201)
    ]
    names = list("abcdefgh")
    df = spark.createDataFrame(table, "a double, b double, c long, d int, e int, f int, g double, h double")
    shares = {"q0": 0.0, "q1": 0.01, "q25": 0.25, "q50": 0.5, "q77": 0.7725, "q100": 1.0}
    got = {r["column_name"]: r for r in select_quantiles(df, names, shares, bins).collect()}
    for k, name in enumerate(names):
        values = sorted((float(r[k]) for r in table if r[k] is not None), key=lambda x: (x != x, x))
        for share, p in shares.items():
            if not values:
                assert got[name][share] is None
                continue
            at = p * (len(values) - 1)
            low, high = values[int(at)], values[-int(-at // 1)]
            expected = low if low == high else (1 - at + int(at)) * low + (at - int(at)) * high
            assert got[name][share] == pytest.approx(expected, rel=1e-12, nan_ok=True), (name, share)


def test_quantiles_with_two_bins(spark):
    df = spark.range(1, 40).select((F.col("id") * F.col("id")).alias("x"))
    assert select_quantiles(df, ["x"], {"q50": 0.5, "q100": 1.0}, 2).first()[1:] == (400.0, 1521.0)
    with pytest.raises(ValueError):
        select_quantiles(df, ["x"], {"q50": 0.5}, 1)


def test_quantiles_read_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for pdf in frames:
            seen.add(len(pdf))
            yield pdf

    df = spark.range(3000).selectExpr("double(id) AS x", "double(id % 7) AS y").mapInPandas(count, "x double, y double")
    rows_of = {r["column_name"]: tuple(r)[1:] for r in select_quantiles(df, ["x", "y"], {"q25": 0.25, "q50": 0.5}, 16).collect()}
    assert rows_of == {"x": (749.75, 1499.5), "y": (1.0, 3.0)} and seen.value == 3000


@KEYED
def test_quantiles_by_group(skewed, rows, limit):
    some = skewed.withColumn("w", F.when(F.col("k").isNull() | (F.col("k") != "c"), F.col("w")))
    shares = {"lo": 0.1, "mid": 0.5, "top": 1.0}
    plain = some.groupBy("k").agg(*[F.percentile("w", F.lit(p)).alias(n) for n, p in shares.items()])
    split = quantiles_by_group(some, ["k"], "w", shares, rows_per_task=limit)
    assert rows(split.select("k", *[F.round(n, 9) for n in shares])) == rows(plain.select("k", *[F.round(n, 9) for n in shares]))


@KEYED
def test_chunks_hold_every_value_once(skewed, rows, limit):
    chunks = collect_in_chunks(skewed, ["k"], "w", "id", 10, rows_per_task=limit)
    assert max(len(r["values"]) for r in chunks.collect()) == 10
    assert rows(chunks.select("k", F.explode("values"))) == rows(skewed, "k", "w")
    sets = collect_set_in_chunks(skewed, ["k"], "v", 5, rows_per_task=limit)
    assert rows(sets.select("k", F.explode("values"))) == rows(skewed.select("k", "v").distinct())
    whole = collect_in_chunks(skewed.filter("k = 'hot'"), ["k"], "w", "id", 1000, rows_per_task=limit)
    assert whole.count() == 1


def test_summary_and_text_profile(skewed, rows):
    got = rows(summarise(skewed, ["v", "w"]), "column_name", "n", "q50")
    assert got == [(c, 300, skewed.agg(F.percentile(c, F.lit(0.5))).first()[0]) for c in ("v", "w")]
    (text,) = profile_text(skewed, ["k"]).collect()
    assert (text["min"], text["max"], text["mean"]) == ("a", "hot", None) and text["n"] + text["n_null"] == 300


@pytest.mark.parametrize("how", ["rollup", "cube"])
def test_distinct_counts_at_every_level(spark, rows, how):
    rnd = random.Random(4)
    table = [(rnd.choice(["a", "b", None]), rnd.randrange(3), rnd.choice([None, -5, 0, 1, 32767, 32768, 32769, 10**7])) for _ in range(200)]
    df = spark.createDataFrame([*table, ("none", 9, None)], "k string, m int, x long")
    plain = getattr(df, how)("k", "m").agg(F.grouping_id().alias("level"), F.count_distinct("x").alias("n"))
    merged = distinct_by_level(df, ["k", "m"], "x", how, "n")
    assert rows(merged, "k", "m", "level", "n") == rows(plain, "k", "m", "level", "n")
    with pytest.raises(ValueError):
        distinct_by_level(df, ["k"], "x", "sets")


def test_distinct_counts_copy_bitmaps_and_no_rows(spark):
    df = spark.range(100_000).select((F.col("id") % 5).alias("k"), (F.col("id") % 3).alias("m"), "id")
    text = plan_text(distinct_by_level(df, ["k", "m"], "id", "cube"), "simple")
    assert text.count("Expand") == 1 and text.index("Expand") < text.index("bitmap_construct_agg")


def test_dense_codes(spark, rows):
    df = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "a"]], "x string")
    assert rows(with_dense_code(df, "x", "code", rows_per_task=1)) == rows(spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3), (None, None)], "x string, code long"))
