"""Row-level changes and past versions of the order table.

The history used here: version 0 loads the orders before 2000, 1 inserts those
of 2000, 2 marks urgent partial orders, 3 deletes small finished orders, and 4
merges everything from July 2000 on with a price rise, which updates what exists
and inserts 2001.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.numbers import money
from loomwell.operators import versions as V
from loomwell.plans.registry import query
from loomwell.session import scratch_path
from loomwell.sources.tables import load

KEYS = ["o_orderkey"]


def committed(day: int) -> Column:
    return F.lit(f"2024-01-0{day + 1} 00:00:00 UTC").cast("timestamp")


def since(day: str) -> Column:
    return F.col("o_orderdate") >= F.lit(day).cast("timestamp_ntz")


def priced_up(orders: DataFrame) -> DataFrame:
    raised = F.round(money("o_totalprice") * F.lit("1.10").cast("decimal(3,2)"), 2).cast("double")
    return orders.withColumn("o_totalprice", raised)


URGENT_PARTIAL = "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
SMALL_FINISHED = "o_orderstatus = 'F' AND o_totalprice < 100000"


def order_log(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    until_2000 = orders.filter(~since("2001-01-01"))
    log = V.as_change(orders.filter(~since("2000-01-01")), 0, "U", "CREATE", committed(0))
    changes = [
        V.as_change(until_2000.filter(since("2000-01-01")), 1, "U", "INSERT", committed(1)),
        V.as_change(
            until_2000.filter(URGENT_PARTIAL).withColumn("o_orderstatus", F.lit("X")), 2, "U", "UPDATE", committed(2)
        ),
        V.as_change(until_2000.filter(SMALL_FINISHED), 3, "D", "DELETE", committed(3)),
        V.as_change(priced_up(orders.filter(since("2000-07-01"))), 4, "U", "MERGE", committed(4)),
    ]
    for change in changes:
        log = V.append_rows(log, change)
    return log


COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
RAISED = "CAST(round(CAST(o_totalprice AS decimal(18,2)) * CAST(1.10 AS decimal(3,2)), 2) AS double)"
LOG = f"""
    WITH log AS (
        SELECT {COLUMNS}, 0 AS v, 'U' AS op FROM orders WHERE o_orderdate < '2000-01-01'
        UNION ALL SELECT {COLUMNS}, 1, 'U' FROM orders WHERE o_orderdate >= '2000-01-01' AND o_orderdate < '2001-01-01'
        UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice, o_orderdate, o_orderpriority, 2, 'U' FROM orders
                  WHERE o_orderdate < '2001-01-01' AND {URGENT_PARTIAL}
        UNION ALL SELECT {COLUMNS}, 3, 'D' FROM orders WHERE o_orderdate < '2001-01-01' AND {SMALL_FINISHED}
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, {RAISED}, o_orderdate, o_orderpriority, 4, 'U' FROM orders
                  WHERE o_orderdate >= '2000-07-01')
"""


def as_of_oracle(version: int) -> str:
    return f"""{LOG}
    SELECT {COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC) AS age
                           FROM log WHERE v <= {version}) WHERE age = 1 AND op = 'U'
    """


@query("ver_as_of_version", as_of_oracle(2))
def ver_as_of_version(spark: SparkSession, d: str) -> DataFrame:
    return V.snapshot(order_log(spark, d), KEYS, version=2)


@query("ver_as_of_timestamp", as_of_oracle(3))
def ver_as_of_timestamp(spark: SparkSession, d: str) -> DataFrame:
    return V.snapshot(order_log(spark, d), KEYS, timestamp="2024-01-04 12:00:00 UTC")


def bucketed_orders(spark: SparkSession, d: str, name: str) -> V.VersionedTable:
    """The same history as commits of a table whose files are dealt by key."""
    orders = load(spark, d, "orders")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = V.VersionedTable(spark, scratch_path(spark, name), KEYS, buckets)
    table.create(orders.filter(~since("2000-01-01")), committed(0))
    table.insert(orders.filter(since("2000-01-01") & ~since("2001-01-01")), committed_at=committed(1))
    table.update(F.expr(URGENT_PARTIAL), {"o_orderstatus": F.lit("X")}, committed(2))
    return table


@query("ver_bucketed_as_of", as_of_oracle(1))
def ver_bucketed_as_of(spark: SparkSession, d: str) -> DataFrame:
    return bucketed_orders(spark, d, "bucketed").as_of(version=1)


@query(
    "ver_bucketed_merge",
    f"""
    SELECT {COLUMNS} FROM ({as_of_oracle(2)}) WHERE o_orderdate < '2000-07-01'
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, {RAISED}, o_orderdate, o_orderpriority
              FROM orders WHERE o_orderdate >= '2000-07-01' AND o_orderdate < '2001-01-01'
    """,
)
def ver_bucketed_merge(spark: SparkSession, d: str) -> DataFrame:
    """A merge that changes what is there and inserts nothing, so that it has to look the keys up in the log."""
    table = bucketed_orders(spark, d, "bucketed-merge")
    table.merge(priced_up(load(spark, d, "orders").filter(since("2000-07-01"))), insert=False, committed_at=committed(3))
    return table.as_of()


@query(
    "ver_history",
    LOG
    + """
    SELECT CAST(v AS bigint) AS _version, ['CREATE', 'INSERT', 'UPDATE', 'DELETE', 'MERGE'][v + 1] AS operation,
           count(*) FILTER (WHERE op = 'U') AS rows_written, count(*) FILTER (WHERE op = 'D') AS rows_deleted,
           TIMESTAMP '2024-01-01' + to_days(CAST(v AS int)) AS committed_at
    FROM log GROUP BY v
    """,
)
def ver_history(spark: SparkSession, d: str) -> DataFrame:
    commits = V.history(order_log(spark, d))
    return commits.withColumn("committed_at", F.to_timestamp_ntz(F.date_format("committed_at", "yyyy-MM-dd HH:mm:ss")))


@query(
    "ver_counts",
    LOG
    + " UNION ALL ".join(
        f"""SELECT CAST({v} AS bigint) AS _version, count(*) AS row_count
        FROM (SELECT op, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC) AS age FROM log WHERE v <= {v})
        WHERE age = 1 AND op = 'U'"""
        for v in range(5)
    ),
)
def ver_counts(spark: SparkSession, d: str) -> DataFrame:
    return V.row_counts(order_log(spark, d), KEYS)


@query(
    "ver_vacuum_dry_run",
    LOG
    + """
    SELECT o_orderkey, CAST(v AS bigint) AS _version, op AS _op FROM (
        SELECT *, lead(v) OVER (PARTITION BY o_orderkey ORDER BY v) AS following FROM log)
    WHERE coalesce(following <= 3, false) OR (op = 'D' AND v <= 3)
    """,
)
def ver_vacuum_dry_run(spark: SparkSession, d: str) -> DataFrame:
    return V.vacuum_dry_run(order_log(spark, d), KEYS, 3).select("o_orderkey", "_version", "_op")


@query("ver_restore", as_of_oracle(1))
def ver_restore(spark: SparkSession, d: str) -> DataFrame:
    log = order_log(spark, d)
    restored = V.append_rows(log, V.restore_change(log, KEYS, 1, 5, committed(5)))
    return V.snapshot(restored, KEYS)


@query(
    "ver_initial_load",
    "SELECT *, true AS is_active, true AS stamped FROM customer",
)
def ver_initial_load(spark: SparkSession, d: str) -> DataFrame:
    table = V.VersionedTable(spark, scratch_path(spark, "initial-load"), ["c_custkey"])
    loaded = load(spark, d, "customer").withColumns({"last_updated": F.current_timestamp(), "is_active": F.lit(True)})
    table.create(loaded)
    table.create(loaded)  # already there: nothing happens
    current = table.as_of()
    return current.withColumn("stamped", F.col("last_updated").isNotNull()).drop("last_updated")


MERGED = f"""
    SELECT {COLUMNS} FROM orders WHERE o_orderdate < '2000-07-01'
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, {RAISED}, o_orderdate, o_orderpriority
              FROM orders WHERE o_orderdate >= '2000-07-01'
"""


@query("ver_merge_upsert", MERGED)
def ver_merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    target = orders.filter(~since("2001-01-01"))
    return V.merge_upsert(target, priced_up(orders.filter(since("2000-07-01"))), KEYS)


@query(
    "ver_merge_delete",
    f"SELECT {COLUMNS} FROM orders WHERE o_orderdate < '2000-07-01' OR o_orderdate >= '2001-01-01'",
)
def ver_merge_delete(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    target = orders.filter(~since("2001-01-01"))
    return V.merge_upsert(target, orders.filter(since("2000-07-01")), KEYS, when_matched="delete")


@query(
    "ver_update",
    f"SELECT o_orderkey, CASE WHEN {URGENT_PARTIAL} THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders",
)
def ver_update(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return V.update_where(orders, F.expr(URGENT_PARTIAL), {"o_orderstatus": F.lit("X")})


@query(
    "ver_delete",
    "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F', false)",
)
def ver_delete(spark: SparkSession, d: str) -> DataFrame:
    # partial orders have a NULL status here, so the condition is NULL and they stay
    orders = load(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return V.delete_where(orders, F.col("status") == "F")


@query("ver_insert", "SELECT * FROM orders")
def ver_insert(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    table = V.VersionedTable(spark, scratch_path(spark, "insert"), KEYS)
    table.create(orders.filter(~since("2000-01-01")))
    table.insert(orders.filter(since("2000-01-01")))
    return table.as_of()


@query(
    "ver_schema_evolution",
    """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= '2000-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders
    """,
)
def ver_schema_evolution(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    table = V.VersionedTable(spark, scratch_path(spark, "evolve"), KEYS)
    table.create(orders.filter(~since("2000-01-01")).select("o_orderkey", "o_totalprice"))
    later = orders.filter(since("2000-01-01")).select("o_orderkey", "o_totalprice", "o_orderpriority")
    table.insert(later, evolve=True)
    return table.as_of()
