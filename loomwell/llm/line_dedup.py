"""Deletion of repeated line runs with a suffix array over line ids.

Lines that occur once in the corpus cannot be part of a repeated run, so only the
others take part, and they break runs. Their ids are ranks in the order of their
hashes. Prefix doubling refines the order: the rank of a position after k rounds is
the place of its suffix when suffixes are compared by their first 2^k lines, so
equal ranks are exactly a longest-common-prefix interval of that depth. Ranks come
from sorting the *distinct* pairs (rank here, rank 2^k lines on), counted before
they travel: a line in a third of all documents is one row of that sort.

A line is deleted if it lies in a run of at least ``min_words`` words that occurs
earlier (by document id, then line). Every such run is covered by windows that reach
``min_words`` words forward from a line or back from one, at most ``min_words`` lines
long. Two overlapping ranks name the content of a window, so doubling ends once
2^k covers half of the longest window: deeper order cannot change a deletion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwell.llm.common import BLANK, written
from loomwell.operators.ordering import join_on_keys, position_by_range

MIN_WORDS = 10


def key_of(doc_id: str, text: str) -> Column:
    """Documents are told apart by id and text; rows equal in both are one document."""
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"))


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per line with a word: its document, place among such lines, place among all, hashes, words."""
    nth = F.transform(F.split(text, "\n"), lambda line, j: F.struct(j.alias("j"), F.trim(line, F.lit(" \t\x0b\f\r")).alias("line")))
    held = docs.filter(F.col(text).isNotNull()).select(
        key_of(doc_id, text).alias("key"), F.posexplode(F.filter(nth, lambda e: e["line"] != "")).alias("i", "e")
    )
    line = F.col("e.line")
    return held.select(
        "key",
        "i",
        F.col("e.j").alias("j"),
        F.xxhash64(line).alias("x"),
        F.xxhash64(F.lit("line"), line).alias("y"),
        # blanks between words, and one; never more than the threshold needs
        F.least(F.size(F.split(line, f"{BLANK}+")), F.lit(1 << 20)).alias("words"),
    )


def ranked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Add the place of each row's ``by`` among the distinct values."""
    places = position_by_range(rows.select(*by).distinct(), [], [F.col(c) for c in by], name)
    # plain shuffles on both sides: a line in many documents is split
    return join_on_keys(rows, places, by).drop(*by)


def suffix_ranks(lines: DataFrame, depth: int) -> DataFrame:
    """``key``, ``i``, ``j``, ``words`` and the ranks ``r0``, ``r1``, ... after each doubling up to ``depth`` lines.

    ``lines`` holds repeated lines only; a gap in ``i`` ends a run, as the end of the document does.
    """
    place = Window.partitionBy("key").orderBy("i")
    rows = ranked(lines, ["x", "y"], "r0").withColumn("run", F.col("i") - F.row_number().over(place))
    level = 0
    while 2 << level <= depth:
        run = Window.partitionBy("key", "run").orderBy("i")
        here, there = f"r{level}", f"r{level}n"
        paired = rows.withColumn(there, F.coalesce(F.lead(here, 1 << level).over(run), F.lit(0).cast("long")))
        places = position_by_range(
            paired.select(here, there).distinct(), [], [F.col(here), F.col(there)], f"r{level + 1}"
        )
        rows = written(paired.join(places, [here, there]).drop(there), "line-ranks")
        level += 1
    return rows


def windows(rows: DataFrame, min_words: int) -> DataFrame:
    """The windows of at least ``min_words`` words from each line forward and back.

    ``name`` is the same for equal contents: the length in lines and the ranks of
    two stretches of 2^k lines, one from the start and one to the end.
    """
    run = Window.partitionBy("key", "run").orderBy("i")

    def reach(step: int) -> Column:
        total, found = F.lit(0), F.lit(None).cast("int")
        cases = []
        for n in range(min_words):
            total = total + F.lead("words", step * n).over(run)
            cases.append((total, n + 1))
        for sums, length in reversed(cases):
            found = F.when(sums >= min_words, F.lit(length)).otherwise(found)
        return found

    lengths = rows.withColumns({"ahead": reach(1), "back": reach(-1)})

    def content(length: int, start: int) -> Column:
        level = length.bit_length() - 1
        parts = [F.lead(f"r{level}", at).over(run) for at in (start, start + length - (1 << level))]
        return F.struct(F.lit(length).alias("lines"), parts[0].alias("from"), parts[1].alias("to"))

    def named(column: str, start) -> Column:
        out = F.lit(None)
        for length in range(min_words, 0, -1):
            out = F.when(F.col(column) == length, content(length, start(length))).otherwise(out)
        return out

    both = lengths.select(
        "key",
        "i",
        "ahead",
        "back",
        named("ahead", lambda n: 0).alias("forward"),
        named("back", lambda n: 1 - n).alias("backward"),
    )
    forward = F.struct(F.col("i").alias("start"), F.col("forward").alias("name"))
    backward = F.struct((F.col("i") - F.col("back") + 1).alias("start"), F.col("backward").alias("name"))
    return both.select("key", F.inline(F.array(forward, backward))).filter("name IS NOT NULL").distinct()


def deleted_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``key`` and ``gone``, the ascending numbers of the lines to delete, for documents that lose any."""
    lines = written(line_table(docs, doc_id, text), "lines")
    repeated = written(lines.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("x", "y"), "line-ids")
    # joined on a struct, so that making the lines distinct cannot reuse the join's dealing, and a hot line is split
    again = join_on_keys(lines, repeated, ["x", "y"]).distinct()
    rows = suffix_ranks(again, min_words)
    found = written(windows(rows, min_words), "line-windows")
    at = F.struct("key", "start")
    # the first place of each content that occurs more than once
    firsts = found.groupBy("name").agg(F.min(at).alias("first"), F.max(at).alias("last")).filter("first <> last").select("name", "first")
    later = found.join(written(firsts, "line-firsts"), "name").filter(at != F.col("first"))
    gone = later.select("key", F.explode(F.sequence("start", F.col("start") + F.col("name.lines") - 1)).alias("i")).distinct()
    return gone.join(rows.select("key", "i", "j"), ["key", "i"]).groupBy("key").agg(F.sort_array(F.collect_list("j")).alias("gone"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows with repeated runs cut out of ``text``, plus the struct ``_cut`` (lines, deleted, words_left).

    Lines are the parts between line feeds; they are compared without blanks at
    their ends, and lines without a word are neither compared nor deleted. The
    first occurrence stays, also of a run that repeats within one document. NULL
    texts stay NULL and empty ones empty; rows equal in id and text all get the
    same result; NULL ids count as one id, before all others.
    """
    gone = deleted_lines(docs, doc_id, text, min_words)
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "gone")
    kept = F.array_join(F.transform(left, lambda j: F.get("_lines", j)), "\n")
    cut = F.struct(
        F.when(F.col("gone").isNull(), F.col("_row")[text]).otherwise(kept).alias("text"),
        F.coalesce(F.size("_lines"), F.lit(0)).alias("lines"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("deleted"),
    )
    # Through a list of one, so that no later filter moves below and splits the text once per line.
    return (
        docs.select(F.struct("*").alias("_row"), key_of(doc_id, text).alias("key"))
        .join(gone, "key", "left")
        .select("_row", "gone", F.split(F.col("_row")[text], "\n").alias("_lines"))
        .select("_row", F.explode(F.array(cut)).alias("_c"))
        .select(
            "_row",
            F.col("_c.text").alias("_text"),
            F.struct("_c.lines", "_c.deleted", F.col("_c.text").rlike(f"[^{BLANK[1:]}").alias("words_left")).alias("_cut"),
        )
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, with all their columns, after deletion; those left without a word by it are dropped."""
    done = without_repeats(docs, doc_id, text, min_words)
    columns = [F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns]
    return done.filter("_cut.deleted = 0 OR _cut.words_left").select(*columns)
