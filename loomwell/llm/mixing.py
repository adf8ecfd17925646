"""Mixing sources to target weights by Pfair scheduling.

A source's rows are cut into blocks of equal row counts. Time runs in slots of one
block. In the ideal flow every source runs at the speed that its weight gives it among
the sources that still have blocks: after virtual time v, source i with b blocks of
weight w has got min(v w, b) of them, and the sum over all sources is the time in slots,
T(v). Block k is released at floor(T(k / w)) and due at ceil(T((k + 1) / w)), and in each
slot the released block with the earliest deadline runs. So a source is always less than
one block away from its share in the flow, for any weights and until the last slot. A
source that runs out leaves its slots to the others: no row is dropped or repeated.
Weights are taken as the decimals they are written as, and all arithmetic is exact.

While no source runs out, the schedule repeats after as many slots as the weights, as
whole numbers in lowest terms, add up to. So the driver works out a plan of single blocks
and repeated rounds from the row counts of the sources; the blocks are listed and joined
to the rows in Spark.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from heapq import heapify, heappop, heappush
from itertools import batched
from math import ceil, floor, gcd, lcm

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.operators.ordering import join_on_keys, position_by_range
from loomwell.session import scratch_path

BLOCK_ROWS = 8
LONGEST = 1 << 20  # slots of a round that is looked for; longer ones are planned block by block
PLAN_ROWS, REPEATS = 1 << 18, 1 << 16
PLAN = "source string, block long, slot long, blocks long, slots long, rounds long"


def whole_weights(weights: list[float]) -> list[int]:
    """Whole numbers in the same proportion as the weights, in lowest terms."""
    exact = [Fraction(str(w)) for w in weights]
    if min(exact) <= 0:
        raise ValueError("weights must be above 0")
    scale = lcm(*(w.denominator for w in exact))
    numbers = [int(w * scale) for w in exact]
    common = gcd(*numbers)
    return [n // common for n in numbers]


class Flow:
    """The ideal flow: T(v) is a line between the times at which sources run out."""

    def __init__(self, blocks: list[int], weights: list[int]):
        self.weights = weights
        self.by_end = sorted(range(len(blocks)), key=lambda i: Fraction(blocks[i], weights[i]))
        self.ends: list[Fraction] = []
        self.gone, self.speed, self.left = [0], [sum(weights)], [0]
        for at, i in enumerate(self.by_end, 1):
            end = Fraction(blocks[i], weights[i])
            if self.ends and self.ends[-1] == end:
                self.gone[-1] += blocks[i]
                self.speed[-1] -= weights[i]
                self.left[-1] = at
            else:
                self.ends.append(end)
                self.gone.append(self.gone[-1] + blocks[i])
                self.speed.append(self.speed[-1] - weights[i])
                self.left.append(at)
        self.phase = [0] * len(blocks)

    def time(self, i: int, k: int) -> tuple[int, int]:
        """T(k / w) of source i as a fraction of whole numbers; k must not fall between the calls for a source."""
        w, p = self.weights[i], self.phase[i]
        end = self.ends[p]
        if k * end.denominator > end.numerator * w:
            p = self.phase[i] = bisect_left(self.ends, Fraction(k, w), p)
        return self.gone[p] * w + k * self.speed[p], w

    def release(self, i: int, k: int) -> int:
        over, w = self.time(i, k)
        return over // w

    def due(self, i: int, k: int) -> int:
        over, w = self.time(i, k + 1)
        return -(-over // w)


def schedule(blocks: list[int], weights: list[int]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Source, block and slot, then how many blocks and slots later the same holds, and how often, itself included.

    A source has at least one block. A round is repeated once the sources stand at its
    end as at its start, as far as all its deadlines come before a source runs out.
    """
    flow = Flow(blocks, weights)
    total, done, slot = sum(blocks), [0] * len(blocks), 0
    waiting: list[tuple[int, int]] = [(0, i) for i in range(len(blocks))]
    ready: list[tuple[int, int]] = []

    def run(until: int) -> Iterator[tuple[int, int, int]]:
        nonlocal slot
        while slot < until:
            while waiting and waiting[0][0] <= slot:
                i = heappop(waiting)[1]
                heappush(ready, (flow.due(i, done[i]), i))
            i = heappop(ready)[1]
            yield i, done[i], slot
            slot += 1
            done[i] += 1
            if done[i] < blocks[i]:
                heappush(waiting, (flow.release(i, done[i]), i))

    for p, end in enumerate(flow.ends):
        ends_at = flow.gone[p] + end * flow.speed[p]
        active = flow.by_end[flow.left[p] :]
        common = 0
        # a round has at least one slot per active source
        if floor(ends_at) - slot >= 5 * len(active):
            common = gcd(*(weights[i] for i in active))
        length = flow.speed[p] // common if common else 0
        while 0 < length <= LONGEST and floor(ends_at) - slot >= 5 * length:
            start, before = slot, {i: done[i] for i in active}
            held = list(run(slot + length))
            if any(done[i] - before[i] != weights[i] // common for i in active):
                yield from ((*x, 0, 0, 1) for x in held)
                continue
            rounds = (floor(ends_at) - start) // length - 3
            yield from ((i, k, s, weights[i] // common, length, rounds) for i, k, s in held)
            slot = start + rounds * length
            for i in active:
                done[i] = before[i] + rounds * (weights[i] // common)
            waiting[:] = [(flow.release(i, done[i]), i) for i in active]
            ready.clear()
            heapify(waiting)
            break
        yield from ((*x, 0, 0, 1) for x in run(min(total, ceil(ends_at))))


def earliest_deadline_first(counts: list[int]) -> list[int]:
    """Which source runs in each slot if source i has ``counts[i]`` blocks and that weight."""
    out = [0] * sum(counts)
    for i, _, slot, _, slots, rounds in schedule(counts, whole_weights(counts)):
        for r in range(rounds):
            out[slot + r * slots] = i
    return out


def plan(
    sources: list[tuple[str | None, int]], weights: dict[str, float], default: float, block_rows: int
) -> tuple[Iterator[tuple], int, dict]:
    """The plan's rows, the number of blocks, and the exact part of all slots that each source is to get."""
    names = [n for n, _ in sources]
    blocks = [ceil(rows / block_rows) for _, rows in sources]
    numbers = whole_weights([weights.get(n, default) for n in names])

    def rows() -> Iterator[tuple]:
        for i, block, slot, step, slots, rounds in schedule(blocks, numbers):
            for r in range(0, rounds, REPEATS):
                yield names[i], block + r * step, slot + r * slots, step, slots, min(REPEATS, rounds - r)

    return rows(), sum(blocks), {n: Fraction(w, sum(numbers)) for n, w in zip(names, numbers)}


def plan_table(spark: SparkSession, lines: Iterator[tuple]) -> DataFrame:
    """The plan as a table; a long one is written in parts, so that the driver holds one part at a time."""
    parts = batched(lines, PLAN_ROWS)
    table, path = spark.createDataFrame(next(parts), PLAN), None
    for part in parts:
        if path is None:
            path = scratch_path(spark, "mixing-plan")
            table.write.parquet(path)
        spark.createDataFrame(part, PLAN).write.mode("append").parquet(path)
    return spark.read.parquet(path) if path else table


def mixed(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    order: tuple[str, ...] = ("doc_id",),
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
    default: float = 1.0,
) -> DataFrame:
    """The ``order`` columns, ``source``, ``block``, ``slot`` and ``in_block`` (from 1) of every row.

    ``weights`` are relative and above 0; sources without one, a NULL source
    included, get ``default``. The rows of a source keep the given order (NULL
    first), repeated rows follow each other. The rows' new order is (slot, in_block).
    """
    spark = docs.sparkSession
    rows = docs.select(*order, F.col(source).cast("string").alias("source"))
    placed = position_by_range(rows, ["source"], [F.col(c) for c in order], "nth")
    sizes = placed.groupBy("source").agg(F.max("nth").alias("rows")).collect()  # one short row per source
    if not sizes:
        return rows.selectExpr("*", "0L AS block", "0L AS slot", "0L AS in_block")
    found = sorted(((r["source"], r["rows"]) for r in sizes), key=lambda x: (x[0] is not None, x[0] or ""))
    lines, _, _ = plan(found, weights or {}, default, block_rows)
    # one row per block
    places = (
        plan_table(spark, lines)
        .repartition("source", "block")
        .withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rounds") - 1)))
        .select(
            "source",
            (F.col("block") + F.col("r") * F.col("blocks")).alias("block"),
            (F.col("slot") + F.col("r") * F.col("slots")).alias("slot"),
        )
    )
    keyed = placed.withColumn("block", F.floor((F.col("nth") - 1) / block_rows))
    return join_on_keys(keyed, places, ["source", "block"]).select(
        *order,
        "source",
        "block",
        "slot",
        ((F.col("nth") - 1) % block_rows + 1).alias("in_block"),
    )


def with_lag(placed: DataFrame, weights: dict[str, float], default: float = 1.0) -> DataFrame:
    """Add to the rows of ``mixed`` the target ``share`` of their source, and ``lag``.

    The lag is the number of blocks that the source has after this one's slot, less
    its share of the slots so far: between -1 and 1. It is NULL from the slot on at
    which the first source runs out, as the others then share its slots.
    """
    weight = F.lit(float(default))
    for name, w in weights.items():
        weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    sources = placed.groupBy("source").agg((F.max("block") + 1).alias("_blocks")).withColumn("_weight", weight)
    total = sources.agg(F.sum("_weight")).scalar()
    first_end = sources.agg(F.min(F.col("_blocks") / F.col("_weight"))).scalar()
    shared = sources.select("source", (F.col("_weight") / total).alias("share"), (first_end * total).alias("_until"))
    so_far = F.col("slot") + 1
    lag = F.when(so_far <= F.col("_until"), F.col("block") + 1 - so_far * F.col("share"))
    return join_on_keys(placed, shared, ["source"]).withColumn("lag", lag).drop("_until")


def in_mixed_order(docs: DataFrame, weights: dict[str, float] | None = None, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """All rows and columns, sorted into the mixed order.

    Rows are told apart by id, source and text; rows equal in all three get one place.
    """
    key = F.struct(F.col(doc_id).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("h"))
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_who"))
    places = mixed(rows.select(F.col("_who"), F.col("_who.source").alias("source")), weights, ("_who",))
    one = places.groupBy("_who").agg(F.min(F.struct("slot", "in_block")).alias("_place"))
    return rows.join(one, "_who").repartitionByRange("_place").sortWithinPartitions("_place").select("_row.*")
