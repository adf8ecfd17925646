"""Headline timings: one JSON line on stdout.

Every query is written to the noop sink, once to warm up and then
``BENCH_RUNS`` times; the median counts. ``value`` is the sum over queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.operators.layout import persisted
from loomwell.plans.catalogue import REGISTRY
from loomwell.session import get_session, release_scratch
from loomwell.sources.tables import load

HEADLINE = [
    "segment_revenue",
    "scan_filter_pushdown",
    "io_partition_prune_two",
    "io_parquet_roundtrip",
    "join_inner",
    "join_broadcast",
    "join_sort_merge",
    "join_skewed_baseline",
    "join_salted_agg",
    "join_filter_after",
    "join_pruned",
    "agg_full",
    "agg_count_distinct",
    "agg_rollup",
    "agg_cube",
    "pivot_multi",
    "stats_describe",
    "stats_summary",
    "win_row_number",
    "win_rank",
    "win_rolling3",
    "win_running",
    "win_share_of_total",
    "win_range_7d",
    "top5_then_agg",
    "dedup_subset",
    "sort_large",
    "word_count",
    "sql_cte_having_rank",
    "str_initcap",
    "udf_python_name",
    "udf_pandas_name",
    "udf_group_zscore",
    "win_zscore",
    "udf_map_in_pandas",
    "sliding_window",
    "ver_merge_upsert",
    "ver_as_of_version",
    "pipe_etl_summary",
    "pipe_upsert",
    "stream_csv_agg",
    "stream_watermark_append",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, runs: int) -> float:
    run()
    laps = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        laps.append(time.perf_counter() - start)
    return round(statistics.median(laps), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    for name in chosen:
        results[name] = timed(lambda q=REGISTRY[name].run: consume(q(spark, sf_dir)), runs)
        release_scratch(spark)

    if not sys.argv[1:]:
        lines = load(spark, sf_dir, "lineitem")
        grouped = lines.groupBy("l_suppkey").agg(F.sum(money("l_extendedprice")).alias("s")).orderBy(F.desc("s"), "l_suppkey")
        # fixed shuffle partition counts, nothing merged at run time
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (200, 20):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results[f"group_sort_{n}_partitions"] = timed(lambda: consume(grouped), runs)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", cpus)

        keyed = lines.select((F.col("l_orderkey") % 10).alias("key"), "l_quantity").repartition(8)
        results["count_uncached"] = timed(lambda: keyed.groupBy("key").count().collect(), runs)
        with persisted(keyed) as held:
            results["count_cached"] = timed(lambda: held.groupBy("key").count().collect(), runs)

    total = round(sum(results.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": results, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
