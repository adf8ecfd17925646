"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps its measurements and
one failure bit per rule; policies are versioned masks over those bits, so a new
policy, or the question what each rule alone removes, needs no second look at a text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import BLANK, whole, words

WINDOW = 3
SYMBOLS = r"[#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """A named bit: the condition, over the measurements, under which a document fails."""

    name: str
    bit: int
    fails: str


# Bits are never reused: a ledger written earlier keeps its meaning.
RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("duplicate_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 20 * n_words"),
)

# version -> rules that reject a document
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words"),
}
BASE, CURRENT = 1, 2


def mask(names: tuple[str, ...]) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[n] for n in names)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``m``, a struct of measurements of the whole text, to the struct ``row`` of all input columns.

    A NULL text measures as an empty one. Windows of three words are told apart
    by a 64-bit hash of the three, within one document only.
    """
    has_word = f"[^{BLANK[1:]}"
    lines = F.filter(F.split(F.col("t"), "\n"), lambda line: line.rlike(has_word))
    hashes = F.when(
        F.size("w") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("w") - WINDOW),
            lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    ordered = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    twice = F.filter(
        "s",
        lambda e, i: (e["x"] == F.get("s", i + 1)["x"]) | ((i > 0) & (e["x"] == F.get("s", i - 1)["x"])),
    )
    covered = F.size(
        F.array_distinct(F.flatten(F.transform("d", lambda e: F.array(*[e["i"] + k for k in range(WINDOW)]))))
    )
    measures = F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.char_length("t") - F.char_length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )
    # The measurements leave through a list of one: no later filter can then be
    # moved below them, where it would evaluate the whole chain anew per list element.
    return (
        docs.select(F.struct("*").alias("row"), whole(F.col(text)).alias("t"))
        .select("row", "t", words(F.col("t")).alias("w"), lines.alias("l"))
        .select("row", "t", "w", "l", hashes.alias("h"))
        # most texts repeat no window: only the others are sorted
        .withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), ordered).otherwise(F.array().cast("array<struct<x:bigint,i:int>>")))
        .withColumn("d", twice)
        .select("row", F.explode(F.array(measures)).alias("m"))
    )


def failures() -> Column:
    """The failure bits of all rules over the columns of a measurement."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total.cast("long")


def rule_ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its id, its measurements, and ``failed``, the bits of the rules it fails.

    NULL ids are kept, repeated rows are each measured, an empty or NULL text has
    zero for every measurement. Other columns are ignored, whatever their names.
    """
    flat = measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("row.doc_id", "m.*")
    return flat.withColumn("failed", failures())


def apply_policy(ledger: DataFrame, version: int = CURRENT) -> DataFrame:
    """Add ``kept``: no rule of the policy failed."""
    return ledger.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablations(ledger: DataFrame, version: int = CURRENT) -> DataFrame:
    """What each rule of a policy does to the whole ledger, from its bits alone.

    ``fails``: documents with the rule's bit; ``only``: those that no other rule
    of the policy rejects, which return if the rule is dropped; ``kept_without``:
    documents kept by the policy without the rule. One aggregate, one row per rule.
    """
    names, every = POLICIES[version], mask(POLICIES[version])
    bit = {n: mask((n,)) for n in names}
    failed = F.col("failed")
    sums = ledger.agg(
        *[F.count_if(failed.bitwiseAND(F.lit(bit[n])) != 0).alias(f"fails_{n}") for n in names],
        *[F.count_if(failed.bitwiseAND(F.lit(every)) == bit[n]).alias(f"only_{n}") for n in names],
        F.count_if(failed.bitwiseAND(F.lit(every)) == 0).alias("kept"),
        F.coalesce(F.bit_or("failed"), F.lit(0)).alias("seen"),
    )
    rows = [
        F.struct(
            F.lit(version).alias("policy"),
            F.lit(n).alias("rule"),
            F.col(f"fails_{n}").alias("fails"),
            F.col(f"only_{n}").alias("only"),
            (F.col("kept") + F.col(f"only_{n}")).alias("kept_without"),
            (F.col("seen").bitwiseAND(F.lit(bit[n])) != 0).alias("ever_failed"),
        )
        for n in names
    ]
    return sums.select(F.inline(F.array(*rows)))


def keep_passing(docs: DataFrame, version: int = CURRENT, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that the policy keeps."""
    bits = measured(docs, text).select("row", "m.*").withColumn("failed", failures())
    return apply_policy(bits, version).filter("kept").select("row.*")


def judged(docs: DataFrame) -> DataFrame:
    """The ledger in the form of the registered query: base verdict and policy verdict."""
    ledger = apply_policy(rule_ledger(docs))
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(mask(POLICIES[BASE]))) != 0).alias("base_failed"),
        "kept",
        "failed",
    )
