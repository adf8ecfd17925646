"""Fill-in-the-middle rewriting by repeated-capture matching.

One full match of ``(unit)*`` against a text keeps every repetition of the unit:
the list of the group's ends holds the number of units and the offset of every cut,
so both cuts are looked up and no text is walked unit by unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwell.llm.common import bound_batches, whole

LINE = r"[^\n]*+\n|[^\n]++"
MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
SEED, PERCENT, SPM_PERCENT = 7, 100, 50

REWRITTEN = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType(), False),
        T.StructField("form", T.StringType(), False),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType(), False),
    ]
)


def unit_ends(unit: str) -> regex.Pattern:
    """The pattern whose group 1 ends once per unit; possessive, so no match is ever taken back."""
    return regex.compile(f"({unit})*+")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 that depend on the seed and the id alone; a NULL id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def rewrite(text: str, h: list[int], pattern: regex.Pattern, marks: tuple[str, str, str], percent: int, spm_percent: int) -> tuple:
    """(units, form, prefix length, middle length, output) of one text."""
    ends = pattern.fullmatch(text).ends(1)
    n = len(ends)
    if not text or h[2] % 100 >= percent or any(m in text for m in marks):
        return n, "plain", None, None, text
    first, last = (ends[k - 1] if k else 0 for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    p, s, m = marks
    if h[3] % 100 < spm_percent:
        return n, "spm", first, last - first, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", first, last - first, f"{p}{prefix}{s}{suffix}{m}{middle}"


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must be told apart wherever they stand: no end of one may begin another."""
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            meet = any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (i != j)))
            if not a or meet or (i != j and a in b):
                raise ValueError(f"the marks {marks} overlap")


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    unit: str = LINE,
    marks: tuple[str, str, str] = MARKS,
    seed: int = SEED,
    percent: int = PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n`` units, ``form``, prefix and middle length, ``output``.

    ``unit`` is a pattern without groups of its own whose repetitions cover every
    text, tried from left to right. ``percent`` of the texts are cut at two unit
    ends drawn from the id; ``spm_percent`` of those put the suffix first. The rest
    stays plain, as does a text that is empty or holds a mark; lengths are then
    NULL. A NULL text is empty. Rows with one id draw alike, a NULL id draws as an
    empty one, and equal rows come back as often as they came. Lengths count code
    points. Other columns are ignored, whatever their names. A unit that does not
    cover a text fails.
    """
    check_marks(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = unit_ends(unit)
        for batch in batches:
            hashes = zip(*[batch.column(2 + k).to_pylist() for k in range(4)])
            done = [rewrite(t, h, pattern, marks, percent, spm_percent) for t, h in zip(batch.column(1).to_pylist(), hashes)]
            columns = [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=REWRITTEN.names)

    bound_batches(docs.sparkSession)
    held = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"), *draws(F.col(doc_id), seed))
    return held.mapInArrow(run, REWRITTEN)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from: its parts lie between the marks, in the order of the form."""
    parts = F.split(output, "|".join(regex.escape(m) for m in marks), -1)
    in_order = F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
    return F.when(form == "plain", output).otherwise(in_order)


def rewritten(docs: DataFrame) -> DataFrame:
    """The registered query: digests of the output and of the text that comes back from it."""
    return fill_in_middle(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
