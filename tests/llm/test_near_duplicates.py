"""Sketch-based near-dedup against all pairs, and SimHash against plain Python."""

import random
import re
from collections import Counter
from hashlib import sha256
from itertools import combinations

import numpy as np
import pytest
import xxhash
from loomwell.llm import minhash, simhash
from loomwell.llm.graph import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, size):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    width = min(size, len(words))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def expected(docs, size, percent=80):
    sets = [(i, shingles(t, size)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in combinations([x for x in sets if x[0] is not None], 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return [(i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets]


def found(df):
    return [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()]


def test_chains_and_hot_groups(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    docs, serial = [], 0
    for group in range(6):
        text = [rnd.choice(vocabulary) for _ in range(60)]
        for _ in range(25 if group else 120):  # each copy edits the one before: links form chains
            text = list(text)
            if rnd.random() < 0.7:
                text[rnd.randrange(60)] = rnd.choice(vocabulary)
            docs.append((serial, " ".join(text)))
            serial += 1
    passage = " ".join(rnd.choice(vocabulary) for _ in range(40))
    for _ in range(60):  # a common passage in texts that are no copies
        docs.append((serial, passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(40))))
        serial += 1
    rnd.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(found(minhash.near_duplicates(frame, size=4))) == sorted(expected(docs, 4))


def test_test_table(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    assert sorted(found(minhash.near_duplicates(table, size=4))) == sorted(expected(docs, 4))


def test_odd_rows(spark):
    long = " ".join(f"x{k}" for k in range(30_000))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "É é"), (7, "é é"), (None, "one two"), (8, long), (9, long + " end")]
    frame = spark.createDataFrame([(*d, "v", 1) for d in docs], "doc_id long, text string, value string, n long")
    key = lambda r: (r[0] is None, r)
    assert sorted(found(minhash.near_duplicates(frame, size=5)), key=key) == sorted(expected(docs, 5), key=key)
    assert minhash.near_duplicates(frame.limit(0)).collect() == []
    twice = found(minhash.near_duplicates(frame.filter("doc_id = 4").union(frame.filter("doc_id = 4"))))
    assert twice == [(4, 1, 4, True)] * 2


def test_a_search_among_some_ids(spark):
    """The others link nothing, and come back neither: 3 is what joins 2 and 5."""
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join([f"x{i}"] * (4 * i) + words[4 * i :]) for i in range(4)]
    docs = [(2, texts[0]), (3, texts[1]), (5, texts[2]), (5, texts[2]), (4, texts[3]), (6, texts[0]), (1, texts[0]), (7, ""), (8, None), (None, texts[0])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for some in ({2, 3, 4, 5, 7}, {2, 5, 6, 8, 99}, set()):
        among = spark.createDataFrame([(i,) for i in some], "doc_id long")
        got = found(minhash.near_duplicates(frame, size=3, among=among))
        assert sorted(got) == sorted(expected([d for d in docs if d[0] in some], 3))
    assert len(found(minhash.near_duplicates(frame, size=3))) == len(docs)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 500)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}


def word_hash(*words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed


def long_hash(value):
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), 42)


def print_of(text):
    words = WORD.findall(text)
    if not words:
        return [0, 0]
    terms = [word_hash(w) for w, n in Counter(w.lower() for w in words).items() for _ in range(n.bit_length())]
    halves = []
    for hashes in (terms, [long_hash(t) for t in terms]):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
        halves.append(sum(1 << k for k in range(simhash.BITS) if votes[k]))
    return halves


def test_fingerprints(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs = sorted((r["doc_id"], r["text"] or "") for r in table.select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in simhash.fingerprinted(table).collect()}
    assert len(got) == len(docs)
    prints = {i: print_of(t) for i, t in docs}
    text = lambda p: "".join(f"{h:016x}" for h in p)
    apart = lambda p, q: sum((x ^ y).bit_count() for x, y in zip(p, q))
    for (i, body), (nxt, following) in zip(docs, docs[1:] + docs[:1]):
        edit = len(body) // 2
        edited = body[: len(body) - edit] + following[:edit]
        row = got[i]
        assert row["n_chars"] == len(body)
        assert row["edited_sha256"] == sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == text(prints[i])
        assert row["edited_fingerprint"] == text(print_of(edited))
        assert row["near_next"] == pytest.approx(1 - apart(prints[i], prints[nxt]) / 126)
        if i % 50 == 0:
            assert row["near_rows"] == sum(apart(prints[i], p) <= simhash.RADIUS for p in prints.values())
    nearer = sum(r["near_edited"] > r["near_next"] for r in got.values())
    assert nearer > 0.85 * len(got)


def test_radius_search_finds_every_pair(spark):
    rnd = random.Random(3)
    base = [(rnd.getrandbits(63), rnd.getrandbits(63)) for _ in range(30)]
    rows = list(base)
    for a, b in base:
        for flips in range(14):
            both = a | b << 63
            for bit in rnd.sample(range(126), flips):
                both ^= 1 << bit
            rows.append((both & (1 << 63) - 1, both >> 63))
    frame = spark.createDataFrame(rows, "a long, b long")
    got = {(r["a"], r["b"]): r["rows"] for r in simhash.within_radius(frame, frame).collect()}
    near = lambda p, q: (p[0] ^ q[0]).bit_count() + (p[1] ^ q[1]).bit_count() <= simhash.RADIUS
    assert got == {p: sum(near(p, q) for q in rows) for p in rows}


@pytest.mark.parametrize("percent", [50, 79, 101])
def test_percents_that_would_lose_links_are_refused(spark, percent):
    with pytest.raises(ValueError, match="percent"):
        minhash.near_duplicates(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), percent=percent)


def test_radius_search_names_what_it_finds(spark):
    rows = [(0, 0), (1, 0), (1, 0), (3, 1), (15, 0), (1 << 62, 1 << 62), (7, 1)]
    asked = [(0, 0), (1 << 62, 1 << 62), (0, 0)]
    frame, queries = (spark.createDataFrame(x, "a long, b long") for x in (rows, asked))
    got = [tuple(r) for r in simhash.pairs_within(frame, queries).collect()]
    apart = lambda p, q: (p[0] ^ q[0]).bit_count() + (p[1] ^ q[1]).bit_count()
    pairs = {(*p, *q, apart(p, q), rows.count(q)) for p in asked for q in rows if apart(p, q) <= simhash.RADIUS}
    assert len(got) == len(pairs) and set(got) == pairs


def test_the_radius_is_bounded_by_the_blocks(spark):
    frame = spark.createDataFrame([(0, 0)], "a long, b long")
    for radius in (-1, 2 * simhash.BLOCKS):
        with pytest.raises(ValueError):
            simhash.pairs_within(frame, frame, radius)


def test_near_copies_lie_within_the_radius(spark):
    """Recall against all pairs: texts of 80 to 400 words, some words replaced, four-word Jaccard of 0.8 or more."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r["text"] for r in table.select("text").collect() if r["text"] and 80 <= len(WORD.findall(r["text"])) <= 400][:120]
    rnd = random.Random(8)
    docs, near = [], []
    for k, text in enumerate(texts):
        words = WORD.findall(text)
        other = list(words)
        for _ in range(rnd.randrange(1, 2 + len(words) // 45)):
            other[rnd.randrange(len(other))] = rnd.choice(rnd.choice(texts).split())
        docs += [(50 * k, " ".join(words)), (50 * k + 1, " ".join(other))]
        a, b = shingles(docs[-2][1], 4), shingles(docs[-1][1], 4)
        if a != b and 100 * len(a & b) >= 80 * len(a | b):
            near.append((50 * k, 50 * k + 1))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in simhash.fingerprinted(frame).collect()}
    found = {(r["fingerprint"], r["found_fingerprint"]) for r in simhash.near_pairs(frame).collect()}
    caught = sum((prints[a], prints[b]) in found for a, b in near)
    assert len(near) > 60 and caught >= 0.9 * len(near)
    # and hardly anything else
    held = {p: i for i, p in prints.items()}
    assert sum(abs(held[a] - held[b]) > 1 for a, b in found) < 0.05 * len(found)


def test_simhash_odd_rows(spark):
    docs = [(5, None), (1, ""), (9, "a b c d"), (9, "a b c d"), (None, "solo"), (7, "😀é " * 3000)]
    frame = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, key string")
    rows = simhash.fingerprinted(frame).collect()
    assert len(rows) == 6  # a row that repeats in full comes back as often
    by = {r["doc_id"]: r for r in rows}
    assert by[5]["fingerprint"] == by[1]["fingerprint"] == "0" * 32
    assert by[7]["n_chars"] == 9000
    assert by[9]["edited_sha256"] == sha256(b"a b so").hexdigest() or by[9]["edited_sha256"] == sha256(b"a b solo"[:7]).hexdigest()
    assert simhash.fingerprinted(frame.limit(0)).collect() == []
    one = simhash.fingerprinted(frame.filter("doc_id = 7")).collect()
    assert one[0]["near_next"] == 1.0
