"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

A text's terms are its words, in lower case. A term that occurs n times weighs as many
votes as n has binary digits, so that neither the commonest words nor one repeated
passage decide: its hash adds them for or against each bit of the fingerprint. Two
hashes of 63 bits give 126 bits.

The fingerprint is cut into ``BLOCKS`` blocks. Of two fingerprints within the radius
some block differs in at most one bit, as the radius is below twice the number of
blocks. Every block has a table of all fingerprints by that block; a query looks up
its block and the same with each bit flipped. Near copies (four-word Jaccard of 0.8 or
more) of the given documents lie 3 to 14 bits apart, nine in ten of them at most 10;
unrelated texts of one language rarely less than 36.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwell.llm.common import whole, words, written
from loomwell.operators.ordering import join_on_keys, position_by_range

BITS = 63  # per half; two halves
LANES, LANE_BITS = 7, 9  # seven counters of nine bits in a long
PIECE = (1 << LANE_BITS) - 1  # votes that a counter can hold
RADIUS, BLOCKS = 11, 6
LEVELS = 31  # a list holds fewer than 2^31 words


def spread(seven: Column) -> Column:
    """The bits of a number below 128, each as a 0 or 1 in a counter of its own."""
    ones = sum(1 << (LANE_BITS * k) for k in range(LANES))
    picks = sum(1 << (LANE_BITS * k + k) for k in range(LANES))
    raise_by = sum(((1 << (LANE_BITS - 1)) - (1 << k)) << (LANE_BITS * k) for k in range(LANES))
    picked = (seven * F.lit(ones)).bitwiseAND(F.lit(picks)) + F.lit(raise_by)
    return F.shiftright(picked, LANE_BITS - 1).bitwiseAND(F.lit(ones))


def weighed() -> str:
    """SQL: of the sorted hashes ``s`` the first, second, fourth, eighth and so on of equal ones."""
    kept = "false"
    for level in reversed(range(LEVELS)):
        # at least the 2^level-th of its kind, and either just that one or one that a higher level keeps
        reached = f"coalesce(get(s, i - {(1 << level) - 1}) = x, false)"
        kept = f"({reached} AND (coalesce(get(s, i - {1 << level}) <> x, true) OR {kept}))"
    return f"filter(s, (x, i) -> {kept})"


def votes_to_bits(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per key with the two fingerprint halves ``a`` and ``b``; keys must be unique.

    A bit is set if more than half of a text's votes are for it.

    Votes are counted in packed counters per piece of a text, then unpacked and
    added up, so no count overflows however long the text is.
    """
    hashes = F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))
    listed = texts.select(*keys, F.sort_array(hashes).alias("s"))
    exploded = listed.select(*keys, F.posexplode_outer(F.expr(weighed())).alias("at", "x")).select(
        *keys,
        F.floor(F.coalesce("at", F.lit(0)) / PIECE).alias("piece"),
        F.col("x").bitwiseAND(F.lit((1 << BITS) - 1)).alias("a"),
        F.xxhash64("x").bitwiseAND(F.lit((1 << BITS) - 1)).alias("b"),
        F.col("x").isNotNull().cast("long").alias("votes"),
    )
    groups = range(BITS // LANES)
    lane = {
        f"{half}{g}": F.coalesce(
            F.sum(F.when(F.col("votes") == 1, spread(F.shiftright(half, LANES * g).bitwiseAND(F.lit(127))))), F.lit(0)
        )
        for half in "ab"
        for g in groups
    }
    packed = exploded.groupBy(*keys, "piece").agg(F.sum("votes").alias("votes"), *[c.alias(n) for n, c in lane.items()])

    def counted(half: str, bit: int) -> Column:
        counter = F.shiftright(f"{half}{bit // LANES}", LANE_BITS * (bit % LANES)).bitwiseAND(F.lit(PIECE))
        return F.sum(counter).alias(f"{half}_{bit}")

    totals = packed.groupBy(*keys).agg(
        F.sum("votes").alias("votes"), *[counted(half, bit) for half in "ab" for bit in range(BITS)]
    )

    def half(name: str) -> Column:
        bits = [F.when(2 * F.col(f"{name}_{k}") > F.col("votes"), F.lit(1 << k)).otherwise(F.lit(0)) for k in range(BITS)]
        while len(bits) > 1:
            bits = [x.bitwiseOR(y) for x, y in zip(bits[::2], bits[1::2])] + bits[len(bits) // 2 * 2 :]
        return bits[0].cast("long").alias(name)

    return totals.select(*keys, half("a"), half("b"))


def distance(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Bits in which the fingerprints (a, b) and (c, d) differ."""
    return F.bit_count(a.bitwiseXOR(c)) + F.bit_count(b.bitwiseXOR(d))


def likeness(a: Column, b: Column, c: Column, d: Column) -> Column:
    return 1 - distance(a, b, c, d) / F.lit(2.0 * BITS)


def as_text(a: Column, b: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def blocks(side: str = "") -> list[Column]:
    """The fingerprint in ``BLOCKS`` parts, as numbers."""

    def bits(half: str, low: int, high: int) -> Column:
        return F.shiftright(side + half, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("long"))

    parts = []
    for low, high in zip(edges(), edges()[1:]):
        if high <= BITS:
            parts.append(bits("a", low, high))
        elif low >= BITS:
            parts.append(bits("b", low - BITS, high - BITS))
        else:
            parts.append(bits("a", low, BITS) + F.shiftleft(bits("b", 0, high - BITS), BITS - low))
    return parts


def edges() -> list[int]:
    return [2 * BITS * k // BLOCKS for k in range(BLOCKS + 1)]


def block_tables(prints: DataFrame) -> DataFrame:
    """One row per fingerprint and table: the table's number and the block that it is ordered by."""
    rows = [F.struct(F.lit(n).alias("table"), part.alias("block")) for n, part in enumerate(blocks())]
    return prints.select("*", F.inline(F.array(*rows)))


def lookups(queries: DataFrame) -> DataFrame:
    """The rows of ``block_tables``, and the same with each bit of the block flipped."""
    flips = [[0, *(1 << k for k in range(high - low))] for low, high in zip(edges(), edges()[1:])]
    listed = F.array(*[F.array(*[F.lit(x).cast("long") for x in f]) for f in flips])
    each = block_tables(queries).withColumn("flip", F.explode(F.get(listed, F.col("table"))))
    return each.withColumn("block", F.col("block").bitwiseXOR(F.col("flip"))).drop("flip")


def pairs_within(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Query fingerprints (``a``, ``b``) with each fingerprint of ``prints`` (``found_a``, ``found_b``) within
    ``radius`` bits, their ``distance`` and the ``rows`` of ``prints`` that hold the found one.

    Both hold ``a`` and ``b``. Equal fingerprints are counted first and searched
    once; a pair is emitted by the first table in which it meets only. Join the
    found fingerprints to those of the documents for the documents: copies are not
    expanded here.
    """
    if not 0 <= radius < 2 * BLOCKS:
        raise ValueError(f"the radius must lie between 0 and {2 * BLOCKS - 1}")
    counted = block_tables(prints.groupBy("a", "b").agg(F.count(F.lit(1)).alias("rows")))
    asked = lookups(queries.select("a", "b").distinct())
    first = F.lit(None).cast("int")
    for n, (x, y) in reversed(list(enumerate(zip(blocks("q."), blocks("p."))))):
        first = F.when(F.bit_count(x.bitwiseXOR(y)) <= 1, F.lit(n)).otherwise(first)
    meet = (F.col("q.table") == F.col("p.table")) & (F.col("q.block") == F.col("p.block"))
    apart = distance(F.col("q.a"), F.col("q.b"), F.col("p.a"), F.col("p.b"))
    pairs = asked.alias("q").join(counted.alias("p"), meet & (apart <= radius) & (F.col("q.table") == first))
    return pairs.select(
        F.col("q.a").alias("a"),
        F.col("q.b").alias("b"),
        F.col("p.a").alias("found_a"),
        F.col("p.b").alias("found_b"),
        apart.cast("long").alias("distance"),
        F.col("p.rows").alias("rows"),
    )


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """How many rows of ``prints`` lie within ``radius`` bits of each query fingerprint."""
    return pairs_within(prints, queries, radius).groupBy("a", "b").agg(F.sum("rows").alias("rows"))


def key_of() -> Column:
    """Id and text hash. The hash can be NULL by its type, as it can once it is read from a file: equal types join without a cast."""
    return F.struct("doc_id", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("h"))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with the key of its successor by id, and the edited text.

    The last floor(n / 2) of n code points are replaced by the first as many (or
    all) of the next document's; the last document is followed by the first. Equal
    ids follow each other by a hash of the text; rows equal in both are one
    document, with the number of its ``copies``. Only ids and lengths are sorted; a text
    moves once to its own row and its first part once to the document before it.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text")).select(
        key_of().alias("key"), "text"
    )
    ids = rows.groupBy("key").agg(F.max(F.char_length("text").cast("long")).alias("n"), F.count(F.lit(1)).alias("copies"))
    placed = written(position_by_range(ids, [], [F.col("key")], "pos"), "simhash-order")
    before = placed.select(
        (F.col("pos") % placed.agg(F.max("pos")).scalar() + 1).alias("pos"),
        F.col("key").alias("before"),
        F.floor(F.col("n") / 2).cast("int").alias("need"),
    )
    order = placed.join(before, "pos").select("key", "before", "need", "n", "copies")
    one = Window.partitionBy("key").orderBy(F.lit(1))
    own = rows.join(order, "key").withColumn("copy", F.row_number().over(one)).filter("copy = 1")
    fill = own.select(F.col("before").alias("key"), F.col("key").alias("next"), F.expr("substring(text, 1, need)").alias("fill"))
    return own.select("key", "n", "copies", "text").join(fill, "key").select(
        "key",
        "next",
        "n",
        "copies",
        "text",
        F.concat(F.expr("left(text, cast(n - floor(n / 2) as int))"), F.col("fill")).alias("edited"),
    )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` (id and text hash), and the fingerprint halves ``a`` and ``b`` of every distinct document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    keyed = rows.select(key_of().alias("key"), "text")
    one = Window.partitionBy("key").orderBy(F.lit(1))
    distinct = keyed.withColumn("copy", F.row_number().over(one)).filter("copy = 1")
    return votes_to_bits(distinct, ["key"], "text")


def documents_and_edits(docs: DataFrame) -> DataFrame:
    """Per distinct document: its key, its successor's, and the fingerprints of its text and its edited text."""
    pairs = with_next(docs)
    versions = F.explode(
        F.array(
            F.struct(F.lit(0).alias("edit"), F.col("text").alias("t"), F.lit("").alias("sha")),
            F.struct(F.lit(1).alias("edit"), F.col("edited").alias("t"), F.sha2("edited", 256).alias("sha")),
        )
    )
    document = ["key", "next", "n", "copies"]
    both = pairs.select(*document, versions.alias("v")).select(*document, "v.*")
    voted = votes_to_bits(both, [*document, "edit", "sha"], "t")
    sides = {
        "a": F.max(F.when(F.col("edit") == 0, F.col("a"))),
        "b": F.max(F.when(F.col("edit") == 0, F.col("b"))),
        "ea": F.max(F.when(F.col("edit") == 1, F.col("a"))),
        "eb": F.max(F.when(F.col("edit") == 1, F.col("b"))),
        "edited_sha256": F.max("sha"),
    }
    return written(voted.groupBy(*document).agg(*[c.alias(n) for n, c in sides.items()]), "simhash")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """The registered query: both fingerprints, their likeness, and what lies within the radius.

    One row per input row: a document that occurs several times, with equal id and
    text, comes back as often. ``near_rows`` is set for ids divisible by 50: the
    number of distinct documents, itself included, within the radius; ``near_pairs``
    names them. A document without words has an all-zero fingerprint.
    """
    prints = documents_and_edits(docs)
    following = prints.select(F.col("key").alias("next"), F.col("a").alias("na"), F.col("b").alias("nb"))
    found = within_radius(prints.select("a", "b"), prints.filter("key.doc_id % 50 = 0"))
    a, b = F.col("a"), F.col("b")
    # many copies share a fingerprint: plain shuffles on both sides let that join be split
    searched = join_on_keys(prints.join(following, "next"), found.withColumnRenamed("rows", "found"), ["a", "b"], "left")
    return (
        searched.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(
            F.col("key.doc_id").alias("doc_id"),
            F.col("n").alias("n_chars"),
            "edited_sha256",
            as_text(a, b).alias("fingerprint"),
            as_text(F.col("ea"), F.col("eb")).alias("edited_fingerprint"),
            likeness(a, b, F.col("ea"), F.col("eb")).alias("near_edited"),
            likeness(a, b, F.col("na"), F.col("nb")).alias("near_next"),
            F.when(F.col("key.doc_id") % 50 == 0, F.col("found")).alias("near_rows"),
        )
    )


def near_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``fingerprint`` of every document whose id 50 divides, and each ``found_fingerprint`` within the radius.

    With ``distance`` and the number of distinct documents that hold the found one;
    ``fingerprinted`` says which these are. Equal fingerprints are one row.
    """
    prints = written(fingerprints(docs, doc_id, text), "simhash-prints")
    pairs = pairs_within(prints.select("a", "b"), prints.filter("key.doc_id % 50 = 0"), radius)
    found = as_text(F.col("found_a"), F.col("found_b")).alias("found_fingerprint")
    return pairs.select(as_text(F.col("a"), F.col("b")).alias("fingerprint"), found, "distance", "rows")
