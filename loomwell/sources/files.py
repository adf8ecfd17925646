"""File reading and writing: CSV, JSON lines, Parquet, ORC, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomwell.session import scratch_path

# Microseconds survive a text copy only when the pattern asks for them.
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header; without a schema Spark scans the data twice to infer one."""
    reader = spark.read.option("header", True).option("timestampNTZFormat", NTZ_FORMAT)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("timestampNTZFormat", NTZ_FORMAT).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("timestampNTZFormat", NTZ_FORMAT).json(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("timestampNTZFormat", NTZ_FORMAT).json(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows from files in the shared scratch folder; what made them is not worked out again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite") -> None:
    """Hive-style directories with few, even files.

    The rebalance hint hashes on the keys so each directory gets few files, and
    adaptive execution splits a partition whose key holds too many rows.
    """
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files differ by added columns; missing ones read as NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def file_layout(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, files and bytes per partition directory of a file-backed table."""
    per_file = df.groupBy(*keys, F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes")
    )
    return per_file.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )
