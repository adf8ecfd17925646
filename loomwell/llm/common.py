"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.session import scratch_path, shared_root

BATCH_BYTES = 16 << 20
BATCH_ROWS = 2000

# [\x20\x09-\x0D]: the white space that separates words
BLANK = r"[ \t\n\x0B\f\r]"


def bound_batches(spark: SparkSession) -> None:
    """Limit what one Arrow batch carries to Python, so that very long texts come in small batches."""
    limits = {"maxBytesPerBatch": BATCH_BYTES, "maxRecordsPerBatch": BATCH_ROWS}
    for name, most in limits.items():
        key = f"spark.sql.execution.arrow.{name}"
        if int(spark.conf.get(key, str(most))) > most:
            spark.conf.set(key, str(most))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_root(df.sparkSession)
    return df.checkpoint()


def whole(text: Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The maximal runs of characters other than the six ASCII blanks, in order.

    Blanks become spaces first: splitting on one fixed character is several
    times cheaper than on a pattern.
    """
    spaced = whole(text)
    for blank in "\t\n\x0b\f\r":
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")
