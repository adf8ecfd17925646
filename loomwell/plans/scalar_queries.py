"""String, array, struct, JSON, date, number and hash columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.functions.text import normalise_name
from loomwell.plans.registry import query
from loomwell.sources.generate import LABELS, pick
from loomwell.sources.tables import load

PROPER = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


@query("str_case", "SELECT c_custkey, upper(c_name) AS upper_name, lower(c_mktsegment) AS lower_segment FROM customer")
def str_case(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").select(
        "c_custkey", F.upper("c_name").alias("upper_name"), F.lower("c_mktsegment").alias("lower_segment")
    )


@query("str_trim", "SELECT c_custkey, trim('  ' || c_name || ' ') AS name, length(trim('  ' || c_name || ' ')) AS n FROM customer")
def str_trim(spark: SparkSession, d: str) -> DataFrame:
    padded = load(spark, d, "customer").withColumn("padded", F.concat(F.lit("  "), "c_name", F.lit(" ")))
    name = F.trim("padded")
    return padded.select("c_custkey", name.alias("name"), F.length(name).cast("long").alias("n"))


@query(
    "str_concat",
    """
    SELECT o_orderkey, o_orderstatus || '/' || o_orderpriority AS joined,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus || '.updated' END AS null_if_any_null
    FROM orders
    """,
)
def str_concat(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select(
        "o_orderkey",
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("joined"),
        F.concat(F.nullif("o_orderstatus", F.lit("F")), F.lit(".updated")).alias("null_if_any_null"),
    )


@query(
    "str_regexp_replace",
    """
    SELECT page_id, regexp_replace(url, '[0-9]+', '#', 'g') AS masked, regexp_replace(url, '^https?://', '') AS no_scheme
    FROM pages
    """,
)
def str_regexp_replace(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pages").select(
        "page_id",
        F.regexp_replace("url", "[0-9]+", "#").alias("masked"),
        F.regexp_replace("url", "^https?://", "").alias("no_scheme"),
    )


@query(
    "str_split",
    """
    SELECT doc_id, len(string_split_regex(text, '\\s+')) AS n_words, string_split_regex(text, '\\s+')[1] AS first_word,
           len(string_split(text, '. ')) AS n_sentences
    FROM documents
    """,
)
def str_split(spark: SparkSession, d: str) -> DataFrame:
    parts = F.split("text", r"\s+")
    return load(spark, d, "documents").select(
        "doc_id",
        F.size(parts).cast("long").alias("n_words"),
        F.get(parts, 0).alias("first_word"),
        F.size(F.split("text", r"\. ")).cast("long").alias("n_sentences"),
    )


@query("str_initcap", f"SELECT p_partkey, {PROPER.format('p_name')} AS name FROM part")
def str_initcap(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select("p_partkey", F.initcap("p_name").alias("name"))


@query(
    "str_normalise_name",
    "SELECT p_partkey, "
    + PROPER.format("replace(replace(trim('  ' || upper(replace(p_name, ' ', '_')) || '-' || lower(p_type) || ' '), '_', ' '), '-', ' ')")
    + " AS name FROM part",
)
def str_normalise_name(spark: SparkSession, d: str) -> DataFrame:
    messy = F.concat(
        F.lit("  "), F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit("-"), F.lower("p_type"), F.lit(" ")
    )
    return load(spark, d, "part").select("p_partkey", normalise_name(messy).alias("name"))


@query(
    "arr_lookup",
    """
    SELECT o_orderkey, ['alpha', 'beta', 'gamma', 'delta', 'epsilon'][CAST(o_orderkey % 5 AS int) + 1] AS label FROM orders
    """,
)
def arr_lookup(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select("o_orderkey", pick(LABELS, F.col("o_orderkey")).alias("label"))


@query(
    "arr_contains",
    "SELECT doc_id, list_contains(string_split_regex(lower(text), '\\s+'), 'the') AS has_the FROM documents",
)
def arr_contains(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select(
        "doc_id", F.array_contains(F.split(F.lower("text"), r"\s+"), "the").alias("has_the")
    )


@query(
    "struct_build_access",
    "SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS priority FROM orders",
)
def struct_build_access(spark: SparkSession, d: str) -> DataFrame:
    packed = load(spark, d, "orders").select(
        "o_orderkey",
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")).alias("detail"),
        ).alias("info"),
    )
    return packed.select("o_orderkey", "info.status", "info.detail.price", "info.detail.priority")


@query(
    "struct_with_field",
    """
    SELECT o_orderkey, o_orderstatus AS status,
           CAST(round(CAST(o_totalprice AS decimal(18,2)) * CAST(1.10 AS decimal(3,2)), 2) AS double) AS price
    FROM orders
    """,
)
def struct_with_field(spark: SparkSession, d: str) -> DataFrame:
    packed = load(spark, d, "orders").select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("price")).alias("info"),
    )
    raised = F.round(F.col("info.price") * F.lit("1.10").cast("decimal(3,2)"), 2)
    return packed.withColumn("info", F.col("info").withField("price", raised)).select(
        "o_orderkey", "info.status", F.col("info.price").cast("double").alias("price")
    )


@query("json_parse", "SELECT event_id, CAST(props->>'$.k' AS bigint) AS k FROM events")
def json_parse(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return load(spark, d, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "json_nested_select",
    """
    SELECT event_type AS operation, user_id AS "user", CAST(props->>'$.k' AS bigint) AS k FROM events
    """,
)
def json_nested_select(spark: SparkSession, d: str) -> DataFrame:
    # nested JSON text, as a commit log would hold, parsed back with one schema
    envelope = F.to_json(
        F.struct(
            F.struct(F.col("event_type").alias("operation"), F.col("user_id").alias("user")).alias("commit"),
            F.struct(F.from_json("props", "k bigint").alias("stats")).alias("add"),
        )
    )
    schema = "commit struct<operation: string, user: bigint>, add struct<stats: struct<k: bigint>>"
    return (
        load(spark, d, "events")
        .select(F.from_json(envelope, schema).alias("log"))
        .select("log.commit.operation", "log.commit.user", "log.add.stats.k")
    )


@query(
    "dt_to_date",
    """
    SELECT o_orderkey, CAST(o_orderdate AS date) AS order_day,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS date) END AS checked_day
    FROM orders
    """,
)
def dt_to_date(spark: SparkSession, d: str) -> DataFrame:
    text = load(spark, d, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(F.col("o_orderstatus") == "F", "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("dirty"),
    )
    return text.select(
        "o_orderkey",
        F.to_date("day", "yyyy-MM-dd").alias("order_day"),
        F.try_to_date("dirty", "yyyy-MM-dd").alias("checked_day"),
    )


@query("dt_to_timestamp", "SELECT event_id, date_trunc('second', ts) AS event_time FROM events")
def dt_to_timestamp(spark: SparkSession, d: str) -> DataFrame:
    text = load(spark, d, "events").select("event_id", F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("t"))
    parsed = F.to_timestamp("t", "yyyy/MM/dd HH:mm:ss")
    return text.select("event_id", parsed.cast("timestamp_ntz").alias("event_time"))


@query(
    "dt_year_month",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS int) AS yr, CAST(month(o_orderdate) AS int) AS mon FROM orders",
)
def dt_year_month(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mon")
    )


@query(
    "dt_lag_ms",
    "SELECT event_id, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1000.0 AS lag_ms FROM events",
)
def dt_lag_ms(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    lag = (F.unix_micros(at) - F.unix_micros(F.date_trunc("day", at))).cast("double") / 1000
    return load(spark, d, "events").select("event_id", lag.alias("lag_ms"))


@query(
    "math_round",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(round(CAST(l_extendedprice AS decimal(18,2)), 1) AS double) AS one_digit,
           CAST(round(CAST(l_extendedprice AS decimal(18,2)), 0) AS double) AS whole
    FROM lineitem
    """,
)
def math_round(spark: SparkSession, d: str) -> DataFrame:
    price = money("l_extendedprice")
    return load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(price, 1).cast("double").alias("one_digit"),
        F.round(price, 0).cast("double").alias("whole"),
    )


@query(
    "math_log_pow",
    "SELECT p_partkey, round(ln(p_retailprice), 6) AS log_price, round(pow(p_size, 2), 6) AS size_squared FROM part",
)
def math_log_pow(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select(
        "p_partkey",
        F.round(F.ln("p_retailprice"), 6).alias("log_price"),
        F.round(F.pow("p_size", F.lit(2)), 6).alias("size_squared"),
    )


@query("hash_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def hash_sha256(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query(
    "math_mod_bucket",
    "SELECT CAST(user_id % 7 AS int) AS bucket, count(*) AS events FROM events GROUP BY 1",
)
def math_mod_bucket(spark: SparkSession, d: str) -> DataFrame:
    bucket = F.pmod("user_id", F.lit(7)).cast("int").alias("bucket")
    return load(spark, d, "events").groupBy(bucket).agg(F.count(F.lit(1)).alias("events"))
