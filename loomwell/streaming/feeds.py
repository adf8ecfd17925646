"""Streaming sources. File streams always take an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomwell.sources.files import NTZ_FORMAT
from loomwell.sources.tables import load


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for stateful streams with one state partition per core.

    A query's number of state partitions is fixed when it first starts, and each
    one costs files on every micro-batch, so neither the batch setting nor
    adaptive execution can be left to choose it.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return session


def rate_feed(spark: SparkSession, rows_per_second: int, partitions: int = 4) -> DataFrame:
    """Rows of (timestamp, value) at a steady rate; use a processing-time trigger with it."""
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions)
        .load()
    )


def file_feed(
    spark: SparkSession, fmt: str, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a folder. Without a limit a trigger takes all files present."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt in ("csv", "json"):
        reader = reader.option("timestampNTZFormat", NTZ_FORMAT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def table_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table read as a stream, in place.

    The braces make the path a glob, which a file stream accepts for a table
    stored as one file as well as for a folder of files.
    """
    schema = load(spark, sf_dir, name).schema
    return file_feed(spark, "parquet", f"{sf_dir}/{{{name}}}.parquet", schema)


def dealt_feed(spark: SparkSession, rows: DataFrame, path: str, portions: list[Column]) -> DataFrame:
    """Rows as a stream of one micro-batch per portion, in the order of the portions.

    Each portion is a condition; its rows are written by a job of their own, as one
    file per core, before the next portion's, and a trigger takes as many files.
    A watermark moves between micro-batches only, so the order of portions decides
    which rows are late, and no batch holds the whole table. Portions need a few
    rows per core, as empty files are not written.
    """
    files = spark.sparkContext.defaultParallelism
    for portion in portions:
        rows.filter(portion).repartition(files).write.mode("append").parquet(path)
    return file_feed(spark, "parquet", path, rows.schema, files)


def in_event_order(rows: DataFrame, ts: str, batches: int) -> list[Column]:
    """Conditions that cut rows into portions of about equal size along the time ``ts``; rows without a time come first."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    shares = [k / batches for k in range(1, batches)]
    cuts = rows.agg(F.percentile_approx(micros, F.array(*map(F.lit, shares)))).first()[0]
    if not cuts:
        return [F.lit(True)]
    edges = sorted(set(cuts))
    inner = [(micros > low) & (micros <= high) for low, high in zip(edges, edges[1:])]
    return [micros.isNull() | (micros <= edges[0]), *inner, micros > edges[-1]]


def with_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zoned timestamp; zone-less columns are read in the session zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))
