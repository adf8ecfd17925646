"""Order-preserving packing of token streams into windows of fixed size.

Documents stay in their order. A window may end after a document or, at a
penalty, after a sentence; dynamic programming picks the cuts with the least sum of
padding and penalties. With cut positions p and f(k) the least cost up to the cut k,

    f(k) = window - p(k) + penalty(k) + min over j of (f(j) + p(j)),  p(k) - p(j) <= window

so the minimum runs over a sliding range of cuts and a monotone queue holds it:
linear in the cuts. A very long sentence gets emergency cuts inside, at a higher
penalty. The stream is cut into ranges of the order, one per partition.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwell.llm.common import bound_batches

WINDOW = 2048
END_ID = 1
SENTENCE_PENALTY, EMERGENCY_PENALTY = 16, 64
LONG_SENTENCE, EMERGENCY_STEP = 256, 32
SEGMENT = 1 << 19  # tokens that one run of the dynamic program covers
TAIL = 8 * WINDOW  # of these, as many at the end are planned again with what follows
CACHED_WORDS = 400_000

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


class Encoder:
    """Token ids of a text, as little-endian 32-bit numbers, sentence by sentence.

    The tokenizer splits a text before every single space, whatever surrounds it,
    so each word's ids are found once and kept. Texts with adjoining blanks, or
    with the string of a special token, are encoded whole.
    """

    def __init__(self, tokenizer: str, ranks: str | None, special: str = "<|endoftext|>"):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer)
        self.special = special
        self.plain = None
        if ranks:
            import public_tokenizers
            import tiktoken

            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
            self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.latin = re.compile("[\n\x20-\x7e\xa1-ɏ]*").fullmatch
        self.first, self.later = WordIds(self, ""), WordIds(self, " ")
        self.blanks = re.compile(r"\s\s").search

    def ids(self, text: str) -> bytes:
        """Ids of a piece of text; the rank table has the same vocabulary and is faster."""
        if self.plain and self.latin(text):
            return np.array(self.plain.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def sentences(self, text: str) -> list[bytes]:
        if "\0" in text or self.special in text or self.blanks(text):
            return self.sentences_of_whole(text)
        for mark in ".!?":
            text = text.replace(f"{mark} ", f"{mark}\0 ").replace(f"{mark}\n", f"{mark}\n\0")
        parts = []
        first, later = self.first.__getitem__, self.later.__getitem__
        for sentence in text.split("\0"):
            words = sentence.split(" ")
            parts.append(first(words[0]) + b"".join(map(later, words[1:])))
        return parts

    def sentences_of_whole(self, text: str) -> list[bytes]:
        found = self.whole.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        if not len(ids):
            return [b""]
        ends = np.array([b for _, b in found.offsets])
        marks = np.array([m.end() for m in re.finditer(r"[.!?](?=\s)", text)], dtype=np.int64)
        cuts = np.unique(np.searchsorted(ends, marks, "right"))
        return [x.tobytes() for x in np.split(ids, cuts[(cuts > 0) & (cuts < len(ids))])]


class WordIds(dict):
    """Word to ids, with what stands before it; full caches stay as they are."""

    def __init__(self, encoder: Encoder, before: str):
        super().__init__()
        self.encoder, self.before = encoder, before

    def __missing__(self, word: str) -> bytes:
        ids = self.encoder.ids(self.before + word)
        if len(self) < CACHED_WORDS and len(word) < 64:
            self[word] = ids
        return ids


ENCODERS: dict[tuple[str, str | None], Encoder] = {}


def encoder(tokenizer: str, ranks: str | None) -> Encoder:
    """One encoder per worker process."""
    if (tokenizer, ranks) not in ENCODERS:
        ENCODERS[tokenizer, ranks] = Encoder(tokenizer, ranks)
    return ENCODERS[tokenizer, ranks]


def tokenizer_files() -> tuple[str, str]:
    """The public tokenizer of the queries, and its vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def best_cuts(at: list[int], penalty: list[int], window: int) -> list[int]:
    """Indices of the chosen cuts; ``at[0]`` is the start, the last cut always is one.

    No two neighbouring cuts lie further apart than ``window``.
    """
    came = [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(at[0], 0)])  # (f + p, index), increasing in both
    for k in range(1, len(at)):
        p = at[k]
        low = p - window
        while at[queue[0][1]] < low:
            queue.popleft()
        best, came[k] = queue[0]
        value = best + window + penalty[k]  # f(k) + p(k)
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, k))
    cuts, k = [], len(at) - 1
    while k:
        cuts.append(k)
        k = came[k]
    return cuts[::-1]


class Stream:
    """The tokens of one partition, planned and given out segment by segment."""

    def __init__(self, window: int, first_id: int):
        self.window, self.sequence = window, first_id
        self.ids: list[bytes] = []
        self.total = 0
        self.at, self.penalty = [0], [0]
        self.docs: list[tuple[int | None, int, int]] = []  # id, where it starts (may be below 0), its tokens

    def add(self, doc_id: int | None, sentences: list[bytes]) -> None:
        start = self.total
        for k, part in enumerate(sentences):
            if k == len(sentences) - 1:
                part += END_ID.to_bytes(4, "little")
            elif not part:
                continue
            size = len(part) // 4
            if size > min(LONG_SENTENCE, self.window):
                step = min(EMERGENCY_STEP, self.window)
                steps = range(self.total + step, self.total + size, step)
                self.at.extend(steps)
                self.penalty.extend([EMERGENCY_PENALTY] * len(steps))
            self.ids.append(part)
            self.total += size
            self.at.append(self.total)
            self.penalty.append(SENTENCE_PENALTY)
        self.penalty[-1] = 0
        self.docs.append((doc_id, start, self.total - start))

    def give(self, last: bool) -> pa.RecordBatch | None:
        """The pieces of all planned windows, but for those near the end unless it is the last call."""
        ends = [self.at[k] for k in best_cuts(self.at, self.penalty, self.window)]
        if not last:
            ends = [e for e in ends if e <= self.total - TAIL]
        if not ends:
            return None
        data, done = b"".join(self.ids), ends[-1]
        windows = np.array([0, *ends], np.int64)
        starts = np.array([s for _, s, _ in self.docs], np.int64)
        sizes = np.array([n for _, _, n in self.docs], np.int64)
        bounds = np.union1d(windows, starts[(starts > 0) & (starts < done)])
        begin, end = bounds[:-1], bounds[1:]
        doc = np.searchsorted(starts, begin, "right") - 1
        window = np.searchsorted(windows, begin, "right") - 1
        view = memoryview(data)
        crc = [zlib.crc32(view[4 * b : 4 * e]) for b, e in zip(begin.tolist(), end.tolist())]
        names = [self.docs[d][0] for d in doc.tolist()]
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int64()),
                pa.array(begin - starts[doc]),
                pa.array(end - begin),
                pa.array(crc, pa.int64()),
                pa.array(sizes[doc]),
                pa.array(self.sequence + window),
                pa.array(begin - windows[window]),
            ],
            names=PIECES.names,
        )
        self.sequence += len(ends)
        keep = int(np.searchsorted(starts + sizes, done, "right"))
        self.docs = [(i, s - done, n) for i, s, n in self.docs[keep:]]
        left = [(a - done, c) for a, c in zip(self.at, self.penalty) if a > done]
        self.at, self.penalty = [0, *(a for a, _ in left)], [0, *(c for _, c in left)]
        self.ids, self.total = [data[4 * done :]], self.total - done
        return batch


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    order: list[Column] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Pieces of documents in windows of at most ``window`` tokens, every token in exactly one piece.

    ``order`` gives the order of the documents (their id by default; rows that are
    equal in it are ordered by their text). A NULL text is empty: its only token is
    the end id. Repeated rows are packed as often as they occur, NULL ids come
    first and stay NULL. Other columns are ignored, whatever their names.
    """
    by = [F.col(doc_id)] if order is None else order
    rows = docs.select(
        *[c.alias(f"_{i}") for i, c in enumerate(by)],
        F.col(doc_id).cast("long").alias("_doc_id"),
        F.col(text).alias("_text"),
    )
    keys = [F.col(f"_{i}") for i in range(len(by))] + [F.col("_doc_id")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks).sentences
        stream = Stream(window, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stream.add(name, encode(body or ""))
                if stream.total >= SEGMENT and (given := stream.give(last=False)):
                    yield given
        if stream.docs and (given := stream.give(last=True)):
            yield given

    bound_batches(docs.sparkSession)
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, F.xxhash64("_text"), "_text")
    return ranged.select("_doc_id", "_text").mapInArrow(run, PIECES)
