"""Streaming sinks and running a query until its input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from loomwell.operators.layout import persisted
from loomwell.operators.versions import VersionedTable
from loomwell.streaming.rows import RowFiles


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything available now, in as many batches as the source wants, then stop."""
    handle = writer.trigger(availableNow=True).start()
    handle.awaitTermination()
    return handle


def to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append-mode file sink; its log makes a restarted batch count once."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    return run_to_end(writer.option("checkpointLocation", checkpoint))


def to_batches(df: DataFrame, path: str, checkpoint: str, mode: str) -> StreamingQuery:
    """Complete or update mode on files: each micro-batch writes a folder of its own.

    A batch that is run again overwrites its own folder, so the result does not
    depend on restarts. In complete mode a batch holds the whole result, so two
    folders take turns and storage does not grow with the batches.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        slot = batch_id % 2 if mode == "complete" else batch_id
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/slot={slot}")

    writer = df.writeStream.outputMode(mode).foreachBatch(save)
    return run_to_end(writer.option("checkpointLocation", checkpoint))


def to_rows(df: DataFrame, writer: RowFiles, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Every row goes through a writer object of its partition and micro-batch."""
    return run_to_end(df.writeStream.outputMode(mode).foreach(writer).option("checkpointLocation", checkpoint))


def last_batch(spark: SparkSession, path: str) -> DataFrame:
    """Result of a complete-mode query: the whole table as of its final batch."""
    batches = spark.read.parquet(path)
    newest = batches.agg(F.max("batch_id").alias("b")).scalar()
    return batches.filter(F.col("batch_id") == newest).drop("batch_id", "slot")


def last_update(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Result of an update-mode query: the newest row of every key."""
    batches = spark.read.parquet(path).drop("slot")
    rest = [c for c in batches.columns if c not in (*keys, "batch_id")]
    newest = F.max(F.struct("batch_id", *rest)).alias("_row")
    return batches.groupBy(*keys).agg(newest).select(*keys, *[f"_row.{c}" for c in rest])


def to_memory(df: DataFrame, name: str, mode: str, checkpoint: str) -> StreamingQuery:
    """In-memory table on the driver, for tests and small demonstrations only."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
    return run_to_end(writer.option("checkpointLocation", checkpoint))


def to_versioned_table(df: DataFrame, table: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch. A batch run again appends equal rows, which changes no read."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch) as held:  # the commit checks the rows and writes them
            if not table.create(held):
                table.merge(held)

    writer = df.writeStream.outputMode("update").foreachBatch(upsert)
    return run_to_end(writer.option("checkpointLocation", checkpoint))


def progress_frame(spark: SparkSession, handle: StreamingQuery) -> DataFrame:
    """Batch id, input rows and watermark of a query's recent batches (a bounded list)."""
    rows = [
        (p.batchId, p.numInputRows, (p.eventTime or {}).get("watermark")) for p in handle.recentProgress
    ]
    return spark.createDataFrame(rows, "batch_id long, input_rows long, watermark string")


def stop_all(spark: SparkSession) -> int:
    """Stop every active query of the session; returns how many there were."""
    active = spark.streams.active
    for handle in active:
        handle.stop()
    return len(active)
