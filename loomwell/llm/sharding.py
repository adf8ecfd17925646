"""Shards through a fixed number of virtual slots.

A record's slot follows from its id alone and never changes. What changes is the map
from slots to shards, a small table kept in versions: a new version copies the last
one with only those slots moved that even out the bytes.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.llm.common import whole
from loomwell.operators.ordering import position_by_range
from loomwell.session import scratch_path

SLOTS = 16384
OVERHEAD = 16
MAP = "version int, slot int, shard int"


def with_slots(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc_id``, ``size`` in bytes, ``text_crc32`` and ``virtual_slot`` of every row.

    A NULL text has no bytes beyond the overhead, and the checksum of an empty
    one; a NULL id hashes like any other value. Repeated rows share a slot.
    """
    body = whole(F.col(text))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.pmod(F.xxhash64(doc_id), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_sizes(placed: DataFrame) -> dict[int, int]:
    """Bytes per slot that holds any: at most as many values as there are slots."""
    rows = placed.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()
    return {r["virtual_slot"]: r["bytes"] for r in rows}


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(held: dict[int, int], sizes: dict[int, int], shards: int) -> dict[int, int]:
    """An edited map: slots move from the fullest to the emptiest shard while that evens them out.

    Each step moves the slot that comes nearest to half of the difference. Every
    move lowers the sum of squares, so it ends; slots that need not move stay.
    """
    edited = dict(held)
    full = [0] * shards
    inside: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in sorted(edited.items()):
        if sizes.get(slot):
            full[shard] += sizes[slot]
            insort(inside[shard], (sizes[slot], slot))
    while True:
        most, least = max(range(shards), key=full.__getitem__), min(range(shards), key=full.__getitem__)
        half = (full[most] - full[least]) // 2
        at = bisect_left(inside[most], (half + 1, -1))
        near = [inside[most][k] for k in (at - 1, at) if 0 <= k < len(inside[most])]
        near = [x for x in near if x[0] < full[most] - full[least]]
        if not near:
            return edited
        size, slot = min(near, key=lambda x: (abs(x[0] - half), x))
        inside[most].remove((size, slot))
        insort(inside[least], (size, slot))
        full[most] -= size
        full[least] += size
        edited[slot] = least


def store_map(spark: SparkSession, path: str, version: int, held: dict[int, int]) -> None:
    """Add one version to the stored map."""
    rows = [(version, slot, shard) for slot, shard in sorted(held.items())]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> dict[int, int]:
    """The map of a version, the newest by default; as many rows as there are slots."""
    table = spark.read.schema(MAP).parquet(path)
    wanted = table.agg(F.max("version")).first()[0] if version is None else version
    return {r["slot"]: r["shard"] for r in table.filter(F.col("version") == wanted).collect()}


def assign(placed: DataFrame, held: dict[int, int]) -> DataFrame:
    """Add ``shard`` through the map, and ``slot``, the row's place in its shard from 0.

    Rows of a shard are ordered by virtual slot, id and checksum. Places come from
    range positions, so no task holds a whole shard.
    """
    spark = placed.sparkSession
    table = spark.createDataFrame(sorted(held.items()), "virtual_slot int, shard int")
    rows = placed.join(F.broadcast(table), "virtual_slot")  # as many rows as there are slots
    order = [F.col(c) for c in ("virtual_slot", "doc_id", "text_crc32", "size")]
    return position_by_range(rows, ["shard"], order, "slot").withColumn("slot", F.col("slot") - 1)


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """The registered query: the map starts even in slots and its second version evens out bytes."""
    spark = docs.sparkSession
    placed = with_slots(docs)
    path = scratch_path(spark, "slot-map")
    store_map(spark, path, 1, first_map(shards))
    store_map(spark, path, 2, rebalanced(load_map(spark, path), slot_sizes(placed), shards))
    return assign(placed, load_map(spark, path)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
