"""Save modes, layouts, schema handling, text output."""

import os

import pytest
from pyspark.sql import functions as F

from loomwell import session
from loomwell.session import scratch_path
from loomwell.sources import files
from loomwell.sources.files import stored
from loomwell.sources.tables import CUSTOMER, load


@pytest.fixture()
def path(spark):
    return scratch_path(spark, "files-test")


def test_save_modes(spark, path):
    two, three = spark.range(2), spark.range(3)
    two.write.mode("overwrite").parquet(path)
    three.write.mode("append").parquet(path)
    assert spark.read.parquet(path).count() == 5
    two.write.mode("ignore").parquet(path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception, match="(?i)already exists"):
        two.write.mode("error").parquet(path)
    three.write.mode("overwrite").parquet(path)
    assert spark.read.parquet(path).count() == 3


def test_csv_inference_and_explicit_schema(spark, path, sf, rows):
    customers = load(spark, sf, "customer")
    files.write_csv(customers, path)
    inferred, declared = files.read_csv(spark, path), files.read_csv(spark, path, CUSTOMER)
    assert inferred.schema["c_acctbal"].dataType.simpleString() == "double"
    assert declared.schema == CUSTOMER
    assert rows(declared) == rows(customers)
    with pytest.raises(Exception, match="(?i)already exists"):
        files.write_csv(customers, path)


def test_partitioned_write_prunes_and_keeps_files_few(spark, path, sf):
    orders = load(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    files.write_partitioned(orders, path, ["year"])
    layout = files.file_layout(spark.read.parquet(path), ["year"]).collect()
    assert len(layout) == 7 and all(r["files"] <= 2 for r in layout)
    assert sum(r["rows"] for r in layout) == orders.count()


def test_merge_schema_reads_missing_columns_as_null(spark, path, rows):
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(f"{path}/b=1")
    spark.createDataFrame([(2, "b", 7)], "k int, v string, w int").write.parquet(f"{path}/b=2")
    assert rows(files.read_merged(spark, path), "k", "v", "w") == [(1, "a", None), (2, "b", 7)]


def test_text_output(spark, path):
    spark.range(5).select(F.col("id").cast("string")).write.text(path)
    assert {r["value"] for r in spark.read.text(path).collect()} == {"0", "1", "2", "3", "4"}


def test_ntz_microseconds_survive_text_copies(spark, path, sf, rows):
    from loomwell.sources.tables import EVENTS

    events = load(spark, sf, "events")
    files.write_json(events, f"{path}/json")
    files.write_csv(events, f"{path}/csv")
    assert rows(files.read_json(spark, f"{path}/json", EVENTS), "event_id", "ts") == rows(events, "event_id", "ts")
    assert rows(files.read_csv(spark, f"{path}/csv", EVENTS), "event_id", "ts") == rows(events, "event_id", "ts")


def test_scratch_is_released(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "HANDED_OUT", [])
    held = stored(spark.range(10), "released")
    (path,) = held.inputFiles()[:1]
    assert held.count() == 10 and session.HANDED_OUT
    unused = scratch_path(spark, "unused")
    assert session.release_scratch(spark) == 2 and session.HANDED_OUT == []
    assert not os.path.exists(path.removeprefix("file://")) and not os.path.exists(unused)
