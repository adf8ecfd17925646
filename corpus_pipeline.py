"""A pipeline over the documents: quality rules, line dedup, near-dedup, source mixing, packing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.llm import line_dedup, minhash, mixing, packing, quality
from loomwell.llm.common import written
from loomwell.session import inner_scratch, scratch_path
from loomwell.sources.tables import load

# Shingles of five words and a similarity of 0.8 make two documents near duplicates.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy.

    A NULL or empty text has too few words and goes; repeated rows go or stay
    together; a NULL id changes nothing.
    """
    return quality.keep_passing(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out; documents that this leaves without a word go.

    NULL and empty texts stay as they are. Rows equal in id and text are one document
    and get the same result. NULL ids count as one id, before all others.
    """
    cut = line_dedup.deduplicated(docs)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast("long"))
    return cut


def ids_of(docs: DataFrame) -> DataFrame:
    return written(docs.select("doc_id").dropna().distinct(), "near-left")


def uncut(spark: SparkSession, docs: DataFrame, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """``doc_id`` and whole text of the documents that are left; one that the table does not hold keeps its own text.

    Of an id that the table holds with several texts, only those that pass the quality rules are left.
    With ``ids``, those of ``docs``, texts of other ids are among them: no text is moved to leave these out.
    """
    left = docs.select("doc_id", "text")
    if not sf_dir:
        return left
    table = load(spark, sf_dir, "documents")
    if ids is None:
        ids = ids_of(left)
        table = table.join(minhash.short_list(ids), "doc_id", "left_semi").select(*table.columns)
    # ids and hashes alone travel to find the ids with several texts and those not in the table
    hashed = table.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(F.min("h").alias("x"), F.max("h").alias("y"))
    several = written(hashed.filter("x <> y").select("doc_id").join(ids, "doc_id", "left_semi"), "near-several")
    whole = table.select("doc_id", "text")
    if not several.isEmpty():
        few = minhash.short_list(several)
        passing = quality.keep_passing(table.join(few, "doc_id", "left_semi").select(*table.columns))
        whole = whole.join(few, "doc_id", "left_anti").unionByName(passing.select("doc_id", "text"))
    foreign = written(ids.join(table.select("doc_id").distinct(), "doc_id", "left_anti"), "near-foreign")
    return whole if foreign.isEmpty() else whole.unionByName(left.join(minhash.short_list(foreign), "doc_id", "left_semi"))


def copies(spark: SparkSession, texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of the ``ids`` that have a smaller one of them near them in ``texts``."""
    path = scratch_path(spark, "near-gone")
    with inner_scratch(spark):
        found = minhash.near_duplicates(texts, size=SHINGLE, percent=PERCENT, among=ids)
        found.filter(~F.col("kept")).select("doc_id").distinct().write.parquet(path)
    return spark.read.parquet(path)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates.

    The texts are compared first as they were before lines were cut: what the cut
    leaves of a near copy is only where it differs, which resembles nothing. What
    remains is compared as it is now: documents that the cut has made alike are near
    duplicates too. A document without words or with a NULL id is like no other and
    stays; repeated rows go or stay together.

    The searches are limited by ids, so that texts stay where they are until the end.
    """
    ids = ids_of(docs)
    gone = copies(spark, uncut(spark, docs, sf_dir, ids), ids)
    if sf_dir:
        rest = written(ids.join(gone, "doc_id", "left_anti"), "near-rest")
        gone = gone.union(copies(spark, docs.select("doc_id", "text"), rest))
    listed = minhash.short_list(gone.withColumnRenamed("doc_id", "_gone"))
    return docs.join(listed, docs["doc_id"] == listed["_gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the mixed order of their sources, which have equal weights; the files hold that order.

    A NULL source is a source of its own. Rows equal in id, source and text follow
    each other; NULL ids come first in their source.
    """
    return mixing.in_mixed_order(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens, in the order in which the documents are stored.

    Rows that do not come from files have no such order and are taken by id. A NULL
    or empty text is one piece with its end token; every row, repeated ones
    included, is packed.
    """
    try:
        place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
        stored, order = docs.select("doc_id", "text", *place), [F.col("file"), F.col("row")]
    except AnalysisException:
        stored, order = docs.select("doc_id", "text"), None
    return packing.pack(stored, *packing.tokenizer_files(), order=order)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("source_mixing", mix_sources),
    ("packing", pack_windows),
]

# Tokenizing and the window cuts are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each reads what the one before has written."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
