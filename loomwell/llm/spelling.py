"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart the shorter (or either, if equally long) is cut into two
disjoint chunks. The edit touches one of them at most, so the other stands in the
longer word as a positional gram, shifted by no more than the difference in length:
a left chunk keeps its place, a right chunk moves by that difference. What is left of
both words is again one edit apart and is cut the same way, so a pair meets on a chunk
and, within it, on a chunk of the rest. A chunk like an ending that a third of all
words have is thereby split into groups of words that share three quarters of their
letters. Pairs that meet are verified letter by letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import checkpointed, whole, written

RUN = r"[^A-Za-zÀ-ÿ]+"  # what separates runs of letters
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EVERY = 199  # one run in so many loses a letter
LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5


def spelled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = EVERY) -> DataFrame:
    """One row ``word`` per run of letters; a run whose hash ``every`` divides has lost one letter."""
    runs = F.explode(F.split(F.translate(whole(F.col(text)), UPPER, LOWER), RUN))
    listed = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), runs.alias("run")).filter("run <> ''")
    drawn = listed.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return drawn.select(F.when(F.col("h") % every == 0, short).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``, its occurrences, of the words that are long and frequent enough."""
    long = words.filter(F.char_length("word") >= least_chars)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def halves(start: Column, length: Column, grown: Column) -> Column:
    """What is known to be equal, and what is left to compare, for each of the two ways to cut a stretch.

    The stretch of the shorter word has ``length`` letters from ``start`` on; in the
    longer word it has ``grown`` letters more, 0 or 1, and starts at the same place.
    """
    left = F.floor(length / 2).cast("int")
    right = length - left
    return F.array(
        F.struct(F.lit("l").alias("side"), start.alias("at"), left.alias("size"), (start + left).alias("rest"), (right + grown).alias("rest_size")),
        F.struct(F.lit("r").alias("side"), (start + left + grown).alias("at"), right.alias("size"), start.alias("rest"), (left + grown).alias("rest_size")),
    )


def chunk_keys(words: DataFrame, grown: int) -> DataFrame:
    """``word``, and its ``key`` for each of the four ways in which a shorter word's chunks can stand in it.

    With ``grown`` 0 the word is cut itself. With 1 it is taken as a word with one
    letter more than the one that was cut; its grams at the places that those
    chunks can have, shifted by one behind the edit, are its keys.
    """
    more = F.lit(grown)
    size = (F.char_length("word") - grown).cast("int")
    once = words.select("word", size.alias("length"), F.explode(halves(F.lit(1), size, more)).alias("a"))
    rest = F.col("a.rest_size") - grown
    twice = once.select("word", "length", "a", F.explode(halves(F.col("a.rest"), rest, more)).alias("b"))

    def gram(cut: str) -> Column:
        return F.substring("word", F.col(f"{cut}.at"), F.col(f"{cut}.size"))

    ways = F.concat(F.col("a.side"), F.col("b.side"))
    return twice.select("word", F.struct(F.col("length"), ways.alias("ways"), gram("a").alias("chunk"), gram("b").alias("second")).alias("key"))


def one_edit(u: Column, v: Column) -> Column:
    """Exactly one letter inserted, deleted or replaced."""
    return F.levenshtein(u, v, 1) == 1


def near_pairs(words: DataFrame) -> DataFrame:
    """``u`` and ``v``, once for each unordered pair of words that one edit turns into each other.

    ``words`` holds distinct words of two letters or more.
    """
    cut = chunk_keys(words, 0)
    same = cut.alias("x").join(cut.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.word") < F.col("y.word")) & one_edit(F.col("x.word"), F.col("y.word")))
    grown = chunk_keys(words, 1)
    longer = cut.alias("x").join(grown.alias("y"), (F.col("x.key") == F.col("y.key")) & one_edit(F.col("x.word"), F.col("y.word")))
    both = [j.select(F.col("x.word").alias("u"), F.col("y.word").alias("v")) for j in (same, longer)]
    return both[0].union(both[1]).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: forms followed to their end, each round twice as far.

    ``forms`` holds ``word`` and ``form``, where a form is more frequent than its
    word, so there is no cycle; words without a form end the chains.
    """
    steps = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = checkpointed(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return steps


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for a table of distinct words with counts ``n``.

    A word's form is its most frequent near word (then the smallest in code-point
    order) if that one is at least ``times`` as frequent.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its word")
    pairs = near_pairs(words.select("word"))
    ways = pairs.select(F.inline(F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("other")), F.struct(F.col("v").alias("word"), F.col("u").alias("other")))))
    offered = ways.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
    best = offered.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("form"))).alias("best"))
    likely = -F.col("best.m") >= times * F.col("n")
    judged = written(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(likely, F.col("best.form")).alias("form"),
            F.when(likely, -F.col("best.m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The variants of all words of a corpus, one row per word.

    A NULL text has no words, a NULL id counts as an empty one. Repeated rows count
    as often as they occur. Other columns are ignored, whatever their names. No row
    comes from a table without frequent words.
    """
    return variants(written(vocabulary(spelled(docs, doc_id, text)), "spelling-words"))
