"""Row-level changes, past versions, and their properties."""

import pytest
from pyspark.sql import functions as F

from loomwell.operators import versions as V
from loomwell.operators.layout import plan_text
from loomwell.session import scratch_path

ORDERS = "order_id long, customer_id int, status string, amount double, region string"
FIRST = [
    (1, 11, "new", 10.0, "N"),
    (2, 12, "sent", 20.0, "S"),
    (3, 13, "new", 30.0, "N"),
    (4, 14, "done", 40.0, "E"),
    (5, 15, "new", 50.0, "S"),
    (6, 16, "sent", 60.0, "N"),
    (7, 17, "void", 70.0, "E"),
    (8, 18, "new", 80.0, "N"),
]


def stamp(day):
    return F.lit(f"2024-03-{day:02d} 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def table(spark):
    t = V.VersionedTable(spark, scratch_path(spark, "orders"), ["order_id"])
    assert t.create(spark.createDataFrame(FIRST, ORDERS), stamp(1))
    t.insert(spark.createDataFrame([(9, 19, "new", 90.0, "S"), (10, 20, "sent", 100.0, "N")], ORDERS), committed_at=stamp(2))
    t.update(F.expr("status = 'new' AND region = 'N'"), {"status": F.lit("held")}, stamp(3))
    t.delete(F.expr("status = 'void'"), stamp(4))
    t.merge(
        spark.createDataFrame([(4, 14, "sent", 45.0, "E"), (6, 16, "done", 60.0, "N"), (42, 52, "new", 9.0, "N")], ORDERS),
        committed_at=stamp(5),
    )
    t.insert(
        spark.createDataFrame([(11, 21, "new", 1.0, "N", "high")], ORDERS + ", priority string"),
        evolve=True,
        committed_at=stamp(6),
    )
    return t


def ids(df):
    return sorted(r["order_id"] for r in df.collect())


def test_versions_and_counts(table, rows):
    assert table.versions() == [0, 1, 2, 3, 4, 5]
    assert [r[1] for r in rows(V.row_counts(table.log(), ["order_id"]))] == [8, 10, 10, 9, 10, 11]
    assert [table.as_of(v).count() for v in range(6)] == [8, 10, 10, 9, 10, 11]


def test_update_and_merge_values(table):
    status = {r["order_id"]: r["status"] for r in table.as_of(2).collect()}
    assert [status[i] for i in (1, 2, 3, 8)] == ["held", "sent", "held", "held"]
    latest = {r["order_id"]: (r["status"], r["amount"]) for r in table.as_of().collect()}
    assert latest[4] == ("sent", 45.0) and latest[6] == ("done", 60.0) and 7 not in latest and 42 in latest


def test_time_travel_by_timestamp(table):
    assert ids(table.as_of(timestamp="2024-03-03 12:00:00")) == ids(table.as_of(2))


def test_old_version_has_old_schema(table):
    assert "priority" not in table.as_of(4).columns
    evolved = {r["order_id"]: r["priority"] for r in table.as_of().collect()}
    assert evolved[11] == "high" and evolved[1] is None


def test_history(table, rows):
    log = table.history().orderBy("_version").select("operation", "rows_written", "rows_deleted").collect()
    assert [tuple(r) for r in log] == [
        ("CREATE", 8, 0),
        ("INSERT", 2, 0),
        ("UPDATE", 3, 0),
        ("DELETE", 0, 1),
        ("MERGE", 3, 0),
        ("INSERT", 1, 0),
    ]


def test_schema_enforcement(spark, table):
    with pytest.raises(ValueError, match="schema mismatch"):
        table.insert(spark.createDataFrame([(50, "x")], "order_id long, surprise string"))
    with pytest.raises(ValueError, match="schema mismatch"):
        table.insert(spark.createDataFrame([(50, "x")], "order_id long, amount string"), evolve=True)
    assert table.versions()[-1] == 5


def test_null_key_is_refused(spark, table):
    with pytest.raises(Exception, match="non-NULL keys"):
        table.insert(spark.createDataFrame([(None, 1, "a", 1.0, "N")], ORDERS))
    assert table.versions()[-1] == 5


def test_vacuum_and_compaction_keep_later_reads(spark, table, rows):
    log = table.log()
    gone = V.vacuum_dry_run(log, ["order_id"], 4)
    # 1, 3, 8 before the update; 7 twice; 4 and 6 before the merge
    assert rows(gone, "order_id", "_version") == sorted(
        [(1, 0), (3, 0), (8, 0), (7, 0), (7, 3), (4, 0), (6, 0)], key=repr
    )
    slim = table.compact_to(scratch_path(spark, "slim"), 4)
    assert slim.log().count() == log.count() - 7
    for v in (4, 5):
        assert rows(slim.as_of(v)) == rows(table.as_of(v))
    with pytest.raises(ValueError):
        slim.as_of(3)


def test_restore_brings_back_each_version(table, rows):
    log = table.log()
    for v in range(6):
        again = V.append_rows(log, V.restore_change(log, ["order_id"], v, 6))
        restored = V.snapshot(again, ["order_id"])
        old = V.snapshot(log, ["order_id"], version=v)
        assert rows(restored, *ORDERS_COLUMNS) == rows(old, *ORDERS_COLUMNS)


ORDERS_COLUMNS = [c.split()[0] for c in ORDERS.split(", ")]


def test_create_restore_overwrite_on_disk(spark, rows):
    t = V.VersionedTable(spark, scratch_path(spark, "cycle"), ["k"])
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert t.create(first)
    assert not t.create(first)
    t.overwrite(spark.createDataFrame([(2, 5), (3, 6)], "k int, w int"))
    assert rows(t.as_of()) == [(2, 5), (3, 6)]
    assert rows(t.as_of(0)) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="changed types"):
        t.overwrite(spark.createDataFrame([(1, "x")], "k int, w string"))


def test_merge_kinds(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "t")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "s"), (None, "s2")], "k int, v string")
    nulls = [(None, "s"), (None, "s2"), (None, "t")]
    assert rows(V.merge_upsert(target, source, ["k"])) == sorted([(1, "a"), (2, "B"), (3, "C"), *nulls], key=repr)
    assert rows(V.merge_upsert(target, source, ["k"], "delete")) == sorted([(1, "a"), (3, "C"), *nulls], key=repr)
    assert rows(V.merge_upsert(target, source, ["k"], "ignore")) == sorted([(1, "a"), (2, "b"), (3, "C"), *nulls], key=repr)
    assert rows(V.merge_upsert(target, source, ["k"], "update", insert=False)) == sorted(
        [(1, "a"), (2, "B"), (None, "t")], key=repr
    )
    once = V.merge_upsert(target.dropna(), source.dropna(), ["k"])
    assert rows(V.merge_upsert(once, source.dropna(), ["k"])) == rows(once)


def test_merge_into_log_with_delete_and_ignore(spark, rows):
    for kind, expected in (("delete", [(1, "a"), (3, "C")]), ("ignore", [(1, "a"), (2, "b"), (3, "C")])):
        t = V.VersionedTable(spark, scratch_path(spark, kind), ["k"])
        t.create(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
        t.merge(spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string"), when_matched=kind)
        assert rows(t.as_of()) == expected


def test_repeated_source_key_fails(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="same key more than once"):
        V.merge_upsert(target, source, ["k"]).collect()


def test_null_condition_selects_nothing(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, s string")
    assert rows(V.delete_where(df, F.col("s") == "x")) == [(1, None)]
    assert rows(V.update_where(df, F.col("s") != "y", {"s": F.lit("z")})) == [(1, None), (2, "z")]


def test_failed_version_is_overwritten(spark, rows):
    t = V.VersionedTable(spark, scratch_path(spark, "retry"), ["k"])
    t.create(spark.createDataFrame([(1,)], "k int"))
    with pytest.raises(Exception):
        t.insert(spark.createDataFrame([(2,), (None,)], "k int"))
    assert t.versions() == [0]
    t.insert(spark.createDataFrame([(3,)], "k int"))
    assert rows(t.as_of()) == [(1,), (3,)]


def test_repeated_and_present_keys_are_refused(spark, rows):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    t = V.VersionedTable(spark, scratch_path(spark, "repeated"), ["k"])
    with pytest.raises(Exception, match="same key more than once"):
        t.create(twice)
    t.create(twice.filter("v <> 'b'"))
    for write in (t.insert, t.overwrite):
        with pytest.raises(Exception, match="same key more than once"):
            write(twice)
    with pytest.raises(Exception, match="key that the table holds"):
        t.insert(spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string"))
    assert rows(t.as_of()) == [(1, "a"), (2, "c")]


def test_a_narrower_source_is_refused(spark):
    target = spark.createDataFrame([(1, "a", "keep")], "k int, v string, w string")
    source = spark.createDataFrame([(1, "b")], "k int, v string")
    t = V.VersionedTable(spark, scratch_path(spark, "narrow"), ["k"])
    t.create(target)
    for merge in (lambda: V.merge_upsert(target, source, ["k"]), lambda: t.merge(source)):
        with pytest.raises(ValueError, match="lacks the columns"):
            merge()
    assert t.as_of().collect()[0]["w"] == "keep"


@pytest.fixture()
def bucketed(spark):
    table = V.VersionedTable(spark, scratch_path(spark, "bucketed-test"), ["id"], buckets=8)
    table.create(spark.range(1000).withColumn("v", F.col("id") * 2))
    table.update(F.col("id") % 10 == 0, {"v": F.lit(-1).cast("long")})
    table.merge(spark.range(990, 1010).withColumn("v", F.lit(7).cast("long")))
    return table


def bare(plan):
    """Lines of the plan that shuffle."""
    return [line for line in plan.splitlines() if " Exchange " in line or line.strip().startswith("Exchange")]


def test_a_bucketed_log_is_read_without_a_shuffle(spark, bucketed, rows):
    for version in (None, 1, 0):
        assert bare(plan_text(bucketed.as_of(version), "simple")) == []
    assert bucketed.as_of().count() == 1010 and bucketed.as_of(1).count() == 1000
    assert bucketed.as_of(1).filter("v = -1").count() == 100 and bucketed.as_of(0).filter("v = -1").count() == 0
    assert rows(bucketed.as_of().filter("id BETWEEN 988 AND 991")) == [(988, 1976), (989, 1978), (990, 7), (991, 7)]


def test_a_join_on_the_keys_of_a_bucketed_log_shuffles_the_other_side_alone(spark, bucketed):
    changes = spark.range(0, 400, 2).hint("merge")
    kept = bucketed.as_of().join(changes, "id", "left_anti")
    assert len(bare(plan_text(kept, "simple"))) == 1
    assert kept.count() == 1010 - 200


def test_bucketed_and_plain_logs_hold_the_same(spark, rows):
    def history(buckets):
        table = V.VersionedTable(spark, scratch_path(spark, "same"), ["id", "k"], buckets)
        table.create(spark.createDataFrame([(k, str(k % 3), k) for k in range(40)], "id long, k string, x long"))
        table.delete(F.col("x") % 4 == 0)
        table.insert(spark.createDataFrame([(0, "0", 5, "new")], "id long, k string, x long, extra string"), evolve=True)
        table.merge(spark.createDataFrame([(1, "1", 9, "m"), (99, "z", 9, "m")], "id long, k string, x long, extra string"), insert=False)
        table.restore(1)
        return table

    plain, dealt = history(None), history(4)
    for version in range(5):
        assert rows(plain.as_of(version)) == rows(dealt.as_of(version))
    slim = dealt.compact_to(scratch_path(spark, "slim"), 3)
    assert rows(slim.as_of()) == rows(plain.as_of()) and bare(plan_text(slim.as_of(), "simple")) == []


def test_a_failed_bucketed_commit_is_not_read(spark, bucketed):
    bad = spark.createDataFrame([(1, 1), (1, 2)], "id long, v long")
    with pytest.raises(Exception, match="more than once"):
        bucketed.merge(bad)
    assert bucketed.versions() == [0, 1, 2] and bucketed.as_of().count() == 1010
    assert bucketed.delete(F.col("id") < 5) == 3
    assert bucketed.as_of().count() == 1005
