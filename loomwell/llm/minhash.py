"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds its distinct word shingles. Its sketch is the set's ``k``
smallest hashes. Inverted lists of the retained values propose pairs; the sketch of
the union estimates their similarity; the full sets decide.

Why no link is lost. Equal sets are one node. Two sets with a Jaccard similarity
of 0.8 share each of the union's smallest values with probability 0.8, so of 32
retained values fewer than ``NEEDED`` (44 %) in common has a probability below
1e-5, and an estimate below one half over 64 values one below 1e-7. Sets that have
t of m values in common meet in the m - t + 1 rarest ones of each, so only those
are listed; values that one document alone has are in no list. Within a list every
document is first paired with the list's smallest one, and estimates sort out most
of these pairs. Then all pairs of a list whose documents are still in different
components are compared by their full sets, in blocks, however many these are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from loomwell.llm.common import bound_batches, written
from loomwell.llm.graph import components
from loomwell.operators.ordering import with_running_totals

KEPT, LISTED, NEEDED = 64, 32, 0.44
LEAST_PERCENT = 80  # NEEDED and the limit of the estimate lose links below it
BROADCAST_IDS = 1_000_000  # eight bytes each
CACHED_WORDS = 100_000  # more are no faster
# shingles in a block of a list, what a small set counts as, and columns of a matrix
BLOCK_ITEMS, LEAST_WEIGHT, MATRIX_COLUMNS = 1 << 16, 128, 8192


class WordHashes(dict):
    """Word to hash, computed on first sight; emptied when it holds too many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z count as a-z.

    A text with fewer words has its whole sequence as its only shingle, one
    without words an empty set.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.int64)
    codes = np.fromiter(map(HASHES.__getitem__, found), np.uint64, len(found))
    width = min(size, len(found))
    count = len(found) - width + 1
    mixed = np.full(count, width, np.uint64)
    for k in range(width):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += codes[k : k + count]
        mixed ^= mixed >> np.uint64(31)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        mixed *= np.uint64(factor)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def release() -> None:
    """At the end of a task: its worker lives on, and the joins that follow need the memory."""
    HASHES.clear()
    pa.default_memory_pool().release_unused()


SKETCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ]
)
SETS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("items", T.ArrayType(T.LongType()))])


def lists_of(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """Per row: its id, set size, digest of the set, and bottom-k sketch in ascending order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    lists_of([s[:KEPT] for s in sets]),
                ],
                names=SKETCH.names,
            )
        release()

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, SKETCH)


def short_list(ids: DataFrame) -> DataFrame:
    """A list of ids to join texts with: below eight MB it spares them a shuffle, whatever Spark's own limit is; a longer one is joined."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """The whole sets of the documents named in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, size) for t in batch.column(1).to_pylist()]
            for k in range(0, len(sets), 64):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 64), lists_of(sets[k : k + 64])], names=SETS.names)
        release()

    bound_batches(docs.sparkSession)
    return docs.join(short_list(ids), "doc_id", "left_semi").mapInArrow(run, SETS)


def estimate(a: Column, b: Column) -> Column:
    """Share of the union's sketch that lies in both sketches."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, KEPT)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union)


def alike(n: Column, m: Column, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return (100 * F.least(n, m)) >= (percent * F.greatest(n, m))


def inverted_lists(nodes: DataFrame) -> DataFrame:
    """``value``, ``doc_id``, ``n``: the rarest retained values of each node that others have too."""
    held = F.least(F.size("sketch"), F.lit(LISTED))
    prefix = held - F.ceil(NEEDED * held) + 1
    entries = nodes.select("doc_id", "n", held.alias("held"), prefix.alias("prefix"), F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    common = written(
        entries.groupBy("value").agg(F.count(F.lit(1)).alias("held_by")).filter("held_by > 1"), "minhash-values"
    )
    by_doc = Window.partitionBy("doc_id")
    ranked = entries.join(common, "value").withColumns(
        {
            "rank": F.row_number().over(by_doc.orderBy("held_by", "value")),
            "shared": F.count(F.lit(1)).over(by_doc),
        }
    )
    return ranked.filter("rank <= prefix - (held - shared)").select("value", "doc_id", "n")


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (``u``, ``v``) whose full sets are as similar as asked."""
    kept = nodes.select("doc_id", "sketch")
    likely = written(
        pairs.join(kept.withColumnsRenamed({"doc_id": "u", "sketch": "su"}), "u")
        .join(kept.withColumnsRenamed({"doc_id": "v", "sketch": "sv"}), "v")
        .filter(estimate(F.col("su"), F.col("sv")) >= 0.5)
        .select("u", "v"),
        "minhash-pairs",
    )
    ids = likely.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    sets = written(full_sets(docs, ids, size), "minhash-sets")
    both = F.size(F.array_intersect("iu", "iv"))
    return (
        likely.join(sets.withColumnsRenamed({"doc_id": "u", "items": "iu"}), "u")
        .join(sets.withColumnsRenamed({"doc_id": "v", "items": "iv"}), "v")
        .filter(100 * both >= percent * (F.size("iu") + F.size("iv") - both))
        .select("u", "v")
    )


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared items of every left and every right set, as products of incidence matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    code, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    order = np.argsort(code, kind="stable")
    order = order[counts[code[order]] > 1]
    both = np.zeros((len(left), len(right)), np.float32)
    if not len(order):
        return both
    column = np.unique(code[order], return_inverse=True)[1]
    for low in range(0, int(column[-1]) + 1, MATRIX_COLUMNS):
        part = slice(*np.searchsorted(column, (low, low + MATRIX_COLUMNS)))
        holds = np.zeros((len(sets), int(column[part][-1]) - low + 1), np.float32)
        holds[owner[order[part]], column[part] - low] = 1
        both += holds[left] @ holds[right].T
    return both


def forest(blocks: np.ndarray, ids: np.ndarray, components_of: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of one unit of work that join different components, at most one per component less one.

    A unit holds the sets of one or two blocks; with two, only pairs across count.
    """
    component = np.unique(components_of, return_inverse=True)[1]
    left, right = np.flatnonzero(blocks == blocks.min()), np.flatnonzero(blocks == blocks.max())
    sizes = np.array([len(s) for s in sets], np.float32)
    both = overlaps(sets, left, right)
    union = sizes[left][:, None] + sizes[right][None, :] - both
    a, b = np.nonzero((100 * both >= percent * union) & (component[left][:, None] != component[right][None, :]))
    parent = list(range(len(ids)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for x, y in zip(left[a].tolist(), right[b].tolist()):
        r, q = root(component[x]), root(component[y])
        if r != q:
            parent[r] = q
            links.append((int(ids[x]), int(ids[y])))
    return links


LINKS = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def unit_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of all units in a partition whose rows are sorted by unit.

    Columns: the unit (value, i, j), block, document, component, items. One unit
    is held at a time, whose size the blocks bound.
    """
    held: list[tuple[np.ndarray, list[np.ndarray]]] = []

    def close() -> list[tuple[int, int]]:
        rows = np.concatenate([r for r, _ in held])
        sets = [s for _, part in held for s in part]
        held.clear()
        return forest(rows[:, 3], rows[:, 4], rows[:, 5], sets, percent)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)], axis=1)
        ends = batch.column(6).offsets.to_numpy()
        flat = batch.column(6).values.to_numpy()
        changes = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        found = []
        if held and (held[-1][0][-1, :3] != rows[0, :3]).any():
            found += close()
        for low, high in zip([0, *changes.tolist()], [*changes.tolist(), len(rows)]):
            if low:
                found += close()
            held.append((rows[low:high], [flat[ends[k] : ends[k + 1]].copy() for k in range(low, high)]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=LINKS.names)
    if held and (found := close()):
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=LINKS.names)


def unsettled_links(texts: DataFrame, placed: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between documents of one list that are in different components.

    The members of a list are ordered by component and cut into blocks of bounded
    size, so the pairs of blocks that lie in one and the same component drop out.
    Each pair of blocks that remains is one unit of work with the full sets.
    """
    mixed = placed.groupBy("value").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        # two hashes of the member set: lists with the same members are compared once
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.bit_xor(F.xxhash64("doc_id")).alias("x"),
            F.bit_xor(F.xxhash64(F.lit("member"), "doc_id")).alias("y"),
        ).alias("members"),
    )
    values = written(mixed.filter("low < high").groupBy("members").agg(F.min("value").alias("value")).select("value"), "minhash-mixed")
    members = written(placed.join(values, "value"), "minhash-open")
    weight = F.greatest("n", F.lit(LEAST_WEIGHT))
    cut = with_running_totals(members, ["value"], [F.col("component"), F.col("doc_id")], {"through": weight})
    cut = written(
        cut.select("value", "doc_id", "component", F.floor((F.col("through") - weight) / BLOCK_ITEMS).alias("block")),
        "minhash-blocks",
    )
    spans = cut.groupBy("value", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    a, b = spans.alias("a"), spans.alias("b")
    one_component = (F.col("a.low") == F.col("a.high")) & (F.col("b.low") == F.col("b.high")) & (F.col("a.low") == F.col("b.low"))
    units = a.join(b, (F.col("a.value") == F.col("b.value")) & (F.col("a.block") <= F.col("b.block")) & ~one_component).select(
        F.col("a.value").alias("value"),
        F.col("a.block").alias("i"),
        F.col("b.block").alias("j"),
        F.explode(F.array_distinct(F.array("a.block", "b.block"))).alias("block"),
    )
    sets = written(full_sets(texts, members.select("doc_id").distinct(), size), "minhash-open-sets")
    work = units.join(cut, ["value", "block"]).join(sets, "doc_id").select("value", "i", "j", "block", "doc_id", "component", "items")
    unit = ["value", "i", "j"]
    return work.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(lambda rows: unit_links(rows, percent), LINKS)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    among: DataFrame | None = None,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every input row.

    Documents are linked where 100 * shared shingles >= ``percent`` * shingles of
    either; ``component_id`` is the smallest id reachable. An empty or NULL text
    has no shingle and no link. A NULL id is linked with nothing, has a NULL
    component and is kept. Rows with one id are one node: equal rows come back as
    often as they came. Other columns are ignored, whatever their names.
    A ``percent`` below LEAST_PERCENT is refused. ``among``, a table of distinct
    ids in ``doc_id``, limits the search to the rows with one of these: all rows
    are sketched and the rest goes then, so that no text is moved for a long list.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must lie between {LEAST_PERCENT} and 100")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = written(sketches(rows, size), "minhash-sketches")
    drawn = sketched.select("doc_id", "n", "digest")
    if among is not None:
        drawn = written(drawn.join(among.select(F.col("doc_id").cast("long")), "doc_id", "left_semi"), "minhash-among")
    filled = drawn.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(filled.groupBy("digest").agg(F.min("doc_id").alias("node")), "minhash-classes")
    # one row per distinct set, and links between rows that share an id but not a set
    first = Window.partitionBy("doc_id", "digest").orderBy(F.lit(1))
    nodes = written(
        sketched.filter("n > 0 AND doc_id IS NOT NULL")
        .join(classes.withColumnRenamed("node", "doc_id"), ["digest", "doc_id"])
        .withColumn("copy", F.row_number().over(first))
        .filter("copy = 1")
        .select("doc_id", "n", "sketch"),
        "minhash-nodes",
    )
    texts = rows.filter("doc_id IS NOT NULL")
    lists = written(inverted_lists(nodes), "minhash-lists")

    heads = lists.groupBy("value").agg(F.min(F.struct("doc_id", "n")).alias("head"), F.count(F.lit(1)).alias("rows"))
    heads = written(heads.filter("rows > 1").select("value", F.col("head.doc_id").alias("u"), F.col("head.n").alias("m")), "minhash-heads")
    stars = (
        lists.join(heads, "value")
        .filter((F.col("u") < F.col("doc_id")) & alike(F.col("n"), F.col("m"), percent))
        .select("u", F.col("doc_id").alias("v"))
        .distinct()
    )
    linked = written(confirmed(texts, nodes, stars, size, percent), "minhash-links")
    joined = components(linked)

    placed = lists.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    placed = written(placed, "minhash-placed")
    more = unsettled_links(texts, placed, size, percent)
    same_id = filled.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter("x <> y").select("doc_id")
    ids = filled.join(same_id, "doc_id", "left_semi").join(classes, "digest").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    final = components(linked.union(more).union(ids))

    return (
        drawn.join(classes, "digest", "left")
        .join(final, "node", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.least("doc_id", F.coalesce("component", "node"))).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
