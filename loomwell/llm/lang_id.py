"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwell.llm.common import bound_batches, written

ORDERS = (1, 2, 3)
BUCKET_BITS = 15  # per order
SMOOTHING = 0.5
MAX_LANGUAGES = 1000  # bounds the broadcast matrix: three orders * 2^15 rows * 4 bytes a language
BLOCK = 1 << 20  # characters scored at once
LETTER = re.compile(r"[^\W\d_]").search
UNKNOWN = "und"

COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("docs", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)
GUESSES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def buckets(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of all orders, in blocks; the ends of the text count as a character 0."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = np.zeros(1, np.uint64)
    codes = np.concatenate([edge, codes, edge])
    for low in range(0, len(codes), BLOCK):
        part = codes[low : low + BLOCK + max(ORDERS) - 1]
        for at, order in enumerate(ORDERS):
            size = min(len(part), BLOCK + order - 1) - order + 1
            if size < 1:
                continue
            mixed = np.zeros(size, np.uint64)
            for k in range(order):
                mixed = (mixed + part[k : k + size] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            yield (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) + (at << BUCKET_BITS)


def learn(docs: DataFrame, lang: str = "lang", text: str = "text") -> dict:
    """The model: its languages and the matrix of log probabilities, one column a language.

    All given rows with a language and a text are counted. Each task adds up its
    own counts first, so what is shuffled does not grow with the texts.
    """
    size = len(ORDERS) << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def give() -> Iterator[pa.RecordBatch]:
            for name, held in sums.items():
                (full,) = held.nonzero()
                one = np.zeros(len(full), np.int64)
                one[:1] = rows[name]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(full)), pa.array(one), pa.array(full.astype(np.int32)), pa.array(held[full])],
                    names=COUNTS.names,
                )
            sums.clear(), rows.clear()

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = sums.get(name)
                if held is None:
                    held = sums[name] = np.zeros(size, np.int64)
                rows[name] = rows.get(name, 0) + 1
                for part in buckets(body):
                    low = int(part[0]) >> BUCKET_BITS << BUCKET_BITS  # all of one order
                    seen = np.bincount(part - low)
                    held[low : low + len(seen)] += seen
            if len(sums) > 64:
                yield from give()
        yield from give()

    bound_batches(docs.sparkSession)
    given = docs.select(F.col(lang), F.col(text)).dropna()
    summed = given.mapInArrow(count, COUNTS).groupBy("lang", "bucket").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = written(summed, "lang-counts")
    if counted.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = counted.toArrow()  # bounded: languages times buckets
    names = sorted(set(table.column("lang").to_pylist()))
    place = {n: k for k, n in enumerate(names)}
    column = np.array([place[n] for n in table.column("lang").to_pylist()], np.int64)
    counts = np.full((size, len(names)), SMOOTHING)
    np.add.at(counts, (table.column("bucket").to_numpy(), column), table.column("n").to_numpy())
    docs_of = np.zeros(len(names))
    np.add.at(docs_of, column, table.column("docs").to_numpy())
    by_order = counts.reshape(len(ORDERS), 1 << BUCKET_BITS, len(names))
    logs = np.log(by_order / by_order.sum(axis=1, keepdims=True)).reshape(size, len(names))
    return {"names": names, "logs": logs.astype(np.float32), "prior": np.log(docs_of / max(docs_of.sum(), 1))}


def guess(text: str | None, model: dict) -> tuple[str, float]:
    """The likeliest language and its posterior probability.

    The n-grams of the several orders overlap, so their evidence is divided by the
    number of orders. A text that is NULL or has no letter is of no language.
    """
    if not text or not model["names"] or not LETTER(text):
        return UNKNOWN, 0.0
    logs = model["logs"]
    total = np.zeros(len(model["names"]))
    for part in buckets(text):
        # sparse row of counts times the matrix: only buckets that occur
        held = np.bincount(part) if len(part) > 4096 else None
        if held is None:
            total += logs[part].sum(axis=0, dtype=np.float64)
        else:
            (full,) = held.nonzero()
            total += held[full] @ logs[full].astype(np.float64)
    total = model["prior"] + total / len(ORDERS)
    best = int(total.argmax())
    return model["names"][best], float(1 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` for every input row, whatever its other columns hold."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [guess(t, held.value) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=GUESSES.names,
            )

    bound_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, GUESSES)


def predicted(docs: DataFrame) -> DataFrame:
    """The registered query: learn from three quarters of the ids, predict for all.

    A row with a NULL id is neither learnt from nor counted as held out.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = learn(docs.filter(fold != 2))
    return identify(docs, model).select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
