"""License notices: an exact set-similarity join of text blocks with templates.

A block is a window of ``2 * STEP`` words that starts every ``STEP`` words, so every
passage of up to ``STEP`` words lies in a block whole. A block belongs to a template
if it holds at least ``PERCENT`` of the template's distinct words. Words that no
template has cannot count, so blocks are sets of template words. All sets are ordered
by the words' frequency over all blocks, the rarest first, and

* length filter: a block with fewer words than a template needs is not compared,
* prefix filter: two sets that share as many words as needed share one of the rarest
  of each, so only these meet in the join,
* positional filter: the place of the first shared word in both sets bounds how many
  more can be shared.

What passes is counted in full, so the result is exactly all blocks at the threshold.
Fixed phrases are searched beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwell.llm.common import bound_batches, written

STEP, PERCENT = 20, 90

# Phrases that stand for a license wherever their words are consecutive.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# The words of common notices.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl-3", "gnu lesser general public license version 3"),
    ("agpl-3", "gnu affero general public license version 3"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "licensed under a creative commons attribution international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

# A-Z as a-z; letters a-z, digits and all bytes of characters beyond ASCII stay; the rest parts words
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

TEXTS = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("blocks", T.ArrayType(T.LongType())),
        T.StructField("held", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


class Notices:
    """Templates as sets of word numbers, with the number of words each needs."""

    def __init__(self, templates: tuple[tuple[str, str], ...], percent: int, step: int):
        if not 1 <= percent <= 100:
            raise ValueError("percent must lie between 1 and 100")
        lists = [words_of(text) for _, text in templates]
        if not all(0 < len(words) <= step for words in lists):
            raise ValueError(f"a template must have 1 to {step} words; cut longer ones or raise the step")
        self.labels = [label for label, _ in templates]
        self.codes = {word: k for k, word in enumerate(sorted({w for words in lists for w in words}))}
        self.sets = [frozenset(self.codes[w] for w in words) for words in lists]
        self.needs = [-(-percent * len(s) // 100) for s in self.sets]

    def larger(self) -> dict[int, list[int]]:
        """Templates of other labels that hold all words of a template and more."""
        every = range(len(self.sets))
        return {k: [m for m in every if self.sets[k] < self.sets[m] and self.labels[k] != self.labels[m]] for k in every}


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def phrase_places(words: list[bytes], phrases: list[tuple[str, bytes]]) -> list[tuple[str, int]]:
    """Label and first word of every place where a phrase's words are consecutive."""
    joined = b" %b " % b" ".join(words)
    places = []
    for label, phrase in phrases:
        at = joined.find(phrase)
        while at >= 0:
            places.append((label, joined.count(b" ", 0, at)))
            at = joined.find(phrase, at + 1)
    return places


def blocks_of(words: list[bytes], codes: dict[bytes, int], step: int, least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers and word sets of the blocks with at least ``least`` template words."""
    found = np.fromiter(map(codes.get, words, repeat(-1)), np.int64, len(words))
    places = np.flatnonzero(found >= 0)
    if len(places) < least:
        return np.empty(0, np.int64), []
    home, width = places // step, len(codes)
    inside = np.concatenate([home, home[home > 0] - 1]) * width + np.concatenate([found[places], found[places[home > 0]]])
    block, code = np.divmod(np.unique(inside), width)
    numbers, starts = np.unique(block, return_index=True)
    sets = np.split(code, starts[1:])
    keep = [k for k, s in enumerate(sets) if len(s) >= least]
    return numbers[keep], [sets[k] for k in keep]


def read_texts(docs: DataFrame, notices: Notices, phrases: tuple[tuple[str, str], ...], step: int) -> DataFrame:
    """Per row: its number, id, words, phrase places, and blocks as sets of template words."""
    least = min(notices.needs, default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = [(label, b" %b " % b" ".join(words_of(phrase))) for label, phrase in phrases]
        for batch in batches:
            counts, labels, starts, blocks, held = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text or "")
                places = phrase_places(words, sought)
                numbers, sets = blocks_of(words, notices.codes, step, least)
                counts.append(len(words))
                labels.append([label for label, _ in places])
                starts.append([at for _, at in places])
                blocks.append(numbers)
                held.append(sets)
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array(c, f) for c, f in zip((counts, labels, starts, blocks, held), ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=TEXTS.names)

    bound_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, TEXTS)


ARROW = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32())))


def prefix_index(spark: SparkSession, notices: Notices, rank: list[int]) -> DataFrame:
    """One row per template and word of its prefix: the word's rank, its place in the set, and the set in order.

    As many rows as the templates have words at most.
    """
    rows = []
    for number, (codes, need) in enumerate(zip(notices.sets, notices.needs)):
        ordered = sorted(rank[c] for c in codes)
        rows += [(ordered[i], number, i, need, ordered) for i in range(len(ordered) - need + 1)]
    return spark.createDataFrame(rows, "token int, template int, i int, need int, wanted array<int>")


def containments(found: DataFrame, notices: Notices) -> DataFrame:
    """``row``, ``block``, ``template`` and ``share`` for every block that meets a template's threshold."""
    if not notices.codes:
        return found.select("row", F.lit(0).cast("long").alias("block"), F.lit(0).alias("template"), F.lit(0.0).alias("share")).limit(0)
    blocks = found.select("row", F.inline(F.arrays_zip("blocks", "held"))).withColumnsRenamed({"blocks": "block"})
    counted = blocks.select(F.explode("held").alias("code")).groupBy("code").count()
    # one count per word of the templates
    count = {r["code"]: r["count"] for r in counted.collect()}
    rank = [0] * len(notices.codes)
    for k, code in enumerate(sorted(range(len(rank)), key=lambda c: (count.get(c, 0), c))):
        rank[code] = k
    ranks = F.array(*map(F.lit, rank))
    ordered = blocks.select("row", "block", F.array_sort(F.transform("held", lambda c: F.get(ranks, c))).alias("t"))
    size, least = F.size("t"), min(notices.needs)
    prefix = ordered.select("row", "block", "t", F.posexplode(F.slice("t", 1, size - least + 1)).alias("j", "token"))
    index = F.broadcast(prefix_index(found.sparkSession, notices, rank))
    room = F.least(F.size("wanted") - F.col("i"), size - F.col("j"))
    shared = F.array_intersect("t", "wanted")
    passed = (size >= F.col("need")) & (F.col("j") <= size - F.col("need")) & (room >= F.col("need"))
    return (
        prefix.join(index, "token")
        .filter(passed)
        .withColumn("shared", shared)
        # a pair counts where it first meets
        .filter((F.size("shared") >= F.col("need")) & (F.get("shared", F.lit(0)) == F.col("token")))
        .select("row", "block", "template", (F.size("shared") / F.size("wanted")).alias("share"))
    )


def without_parts(matches: DataFrame, notices: Notices) -> DataFrame:
    """Drop a template from a block that also meets one which holds all its words and more."""
    larger = notices.larger()
    table = F.array(*[F.array(*map(F.lit, larger[k])).cast("array<int>") for k in sorted(larger)]).cast("array<array<int>>")
    grouped = matches.groupBy("row", "block").agg(F.collect_list(F.struct("template", "share")).alias("m"))
    kept = F.filter("m", lambda e: ~F.arrays_overlap(F.get(table, e["template"]), F.transform("m", lambda o: o["template"])))
    return grouped.select("row", "block", F.inline(kept))


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    percent: int = PERCENT,
    step: int = STEP,
) -> tuple[DataFrame, DataFrame]:
    """The texts (``row``, ``doc_id``, ``n_words``, ``labels`` and ``starts`` of phrases) and the matches.

    A match has the text's ``row``, ``label``, the first and last word of the block
    (``from_word``, ``to_word``) and ``share``, the part of the template's words in it.

    One text per input row, equal rows included; NULL ids stay NULL; a NULL or empty
    text has no words and no match. Blocks at the end may be short. Equal shares all
    count. Other columns are ignored, whatever their names. The templates, each of
    at most ``step`` words, are a parameter that the driver holds.
    """
    notices = Notices(templates, percent, step)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = written(read_texts(rows, notices, phrases, step), "license-texts")
    matches = without_parts(containments(found, notices), notices)
    labels = F.array(*map(F.lit, notices.labels)) if templates else F.array(F.lit(""))
    from_word = F.col("block") * step
    spans = matches.select("row", F.get(labels, F.col("template")).alias("label"), from_word.alias("from_word"), (from_word + 2 * step - 1).alias("to_word"), "share")
    return found.select("row", "doc_id", "n_words", "labels", "starts"), spans


def scanned(docs: DataFrame) -> DataFrame:
    """The registered query: phrase places and labels per text; ``score`` is 1 for a phrase, else the best share."""
    texts, matches = scan(docs)
    best = matches.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    every = F.sort_array(F.array_distinct(F.concat("labels", F.coalesce("more", F.array().cast("array<string>")))))
    has_phrase = F.size("labels") > 0
    return texts.join(best, "row", "left").select(
        "doc_id",
        "n_words",
        F.size("labels").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"),
        F.array_max("starts").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct("labels")), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(has_phrase, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
