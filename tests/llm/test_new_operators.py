"""License scans, fill-in-the-middle and spelling variants against plain Python and SQL."""

import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from compare import connect, differences
from loomwell.llm import fim, license_scan, spelling
from loomwell.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_fill_in_middle", "op13_spelling_variants"])
def test_equals_its_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None


# license scans

SMALL = (("a", "red green blue cyan"), ("b", "red green blue cyan magenta"), ("c", "one two three four five six seven eight"))


def plain_matches(text, templates, percent, step):
    """All blocks of all templates by counting."""
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    sets = [(label, set(body.split())) for label, body in templates]
    found = set()
    for block in range(len(words) // step + 1):
        held = set(words[block * step : (block + 2) * step])
        if not words[block * step :]:
            continue
        met = [(label, t) for label, t in sets if 100 * len(held & t) >= percent * len(t)]
        for label, t in met:
            if not any(o != label and t < s for o, s in met):
                found.add((label, block * step, round(len(held & t) / len(t), 6)))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_blocks_equal_all_comparisons(spark, seed):
    rnd = random.Random(seed)
    pool = sorted({w for _, t in SMALL for w in t.split()}) + ["x", "y", "z"]
    texts = [" ".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 60))) for _ in range(60)]
    texts += [SMALL[2][1].upper() + ".", "red-green, blue\ncyan", "", None]
    docs = spark.createDataFrame([(k, t, "r") for k, t in enumerate(texts)], "doc_id long, text string, row string")
    found, matches = license_scan.scan(docs, templates=SMALL, percent=75, step=8)
    got = {}
    for r in matches.join(found.select("row", "doc_id"), "row").collect():
        got.setdefault(r["doc_id"], set()).add((r["label"], r["from_word"], round(r["share"], 6)))
    for k, t in enumerate(texts):
        assert got.get(k, set()) == plain_matches(t, SMALL, 75, 8), t


def test_license_odd_rows(spark):
    notice = "Licensed under the GNU Lesser General Public License, version 3."
    long = "Word " * 300_000 + "Under the MIT-License. " + "word " * 10
    rows = [(1, None), (2, ""), (3, "!?\n"), (4, notice), (4, notice), (None, "cc-by-nc CC BY\nNC"), (5, long), (6, "éunder the mit license"), (7, "under the mit licenseé")]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, labels string, n_words int")
    got = sorted((tuple(r) for r in license_scan.scanned(docs).collect()), key=repr)
    assert got == sorted(
        [
            (1, 0, 0, None, None, "", "", 0.0),
            (2, 0, 0, None, None, "", "", 0.0),
            (3, 0, 0, None, None, "", "", 0.0),
            (4, 10, 0, None, None, "", "lgpl-3", 1.0),
            (4, 10, 0, None, None, "", "lgpl-3", 1.0),
            (None, 6, 2, 0, 3, "cc-by-nc", "cc-by-nc", 1.0),
            (5, 300_014, 1, 300_000, 300_000, "mit", "mit", 1.0),
            (6, 4, 0, None, None, "", "", 0.0),
            (7, 4, 0, None, None, "", "", 0.0),
        ],
        key=repr,
    )
    assert license_scan.scanned(docs.limit(0)).collect() == []


def test_templates_are_checked(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    with pytest.raises(ValueError):
        license_scan.scan(docs, templates=(("long", "w " * 21),))
    with pytest.raises(ValueError):
        license_scan.scan(docs, templates=(("none", " . "),))
    texts, matches = license_scan.scan(docs, templates=())
    assert texts.count() == 1 and matches.count() == 0


def test_a_notice_across_block_edges_is_found(spark):
    """Every passage of up to STEP words lies in one block, wherever it starts."""
    notice = license_scan.TEMPLATES[9][1]
    assert len(notice.split()) == license_scan.STEP
    docs = spark.createDataFrame([(k, "lorem " * k + notice + " ipsum" * 30) for k in range(45)], "doc_id long, text string")
    labels = {r["doc_id"]: r["labels"] for r in license_scan.scanned(docs).collect()}
    assert set(labels.values()) == {"isc"}


# fill in the middle


def plain_fim(doc_id, text):
    text = text or ""
    h = sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 50 else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_cuts_and_round_trip(spark):
    rnd = random.Random(5)
    texts = [None, "", "\n", "\n\n", "one line", "a<P>b", "x<\nS>", "<", ">", "<S", "M>\n<", "\r\n\x0b", "é𝄞\nñ" * 3, "line\n" * 200_000 + "end"]
    texts += ["".join(rnd.choice(["a", "é", "\n", "<", "S", ">", "P"]) for _ in range(rnd.randrange(40))) for _ in range(150)]
    rows = [(k, t, "f", 1) for k, t in enumerate(texts)] + [(None, "a\nb\n", "f", 1), (7, "twice\n", "f", 1), (7, "twice\n", "f", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")
    done = fim.fill_in_middle(docs)
    back = done.select("*", fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    got = sorted((tuple(r) for r in back), key=repr)
    assert got == sorted(((d, *plain_fim(d, t), t or "") for d, t, *_ in rows), key=repr)
    assert fim.rewritten(docs.limit(0)).collect() == []


def test_other_units_shares_and_marks(spark):
    docs = spark.createDataFrame([(k, "some words in a row") for k in range(200)], "doc_id long, text string")
    word = r"\S++\s*+|\s++"
    done = fim.fill_in_middle(docs, unit=word, percent=40, spm_percent=0, marks=("[p]", "[s]", "[m]"))
    rows = done.select("*", fim.restored(F.col("output"), F.col("form"), ("[p]", "[s]", "[m]")).alias("back")).collect()
    assert {r["n"] for r in rows} == {5} and {r["back"] for r in rows} == {"some words in a row"}
    forms = Counter(r["form"] for r in rows)
    assert set(forms) == {"plain", "psm"} and 50 < forms["psm"] < 110
    for marks in (("<a>", "<a>", "<b>"), ("ab", "bc", "x"), ("aba", "x", "y"), ("", "x", "y"), ("xyz", "y", "a")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(docs, marks=marks)


# spelling variants


def edits(word, letters):
    for k in range(len(word) + 1):
        yield from (word[:k] + c + word[k:] for c in letters)
        if k < len(word):
            yield word[:k] + word[k + 1 :]
            yield from (word[:k] + c + word[k + 1 :] for c in letters)


def plain_variants(counts):
    letters = {c for w in counts for c in w}
    near = {w: {e for e in edits(w, letters) if e in counts and e != w} for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_near_words_equal_all_comparisons(spark, seed):
    rnd = random.Random(seed)
    letters = "abé" if seed % 2 else "ab"
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(6, 12))) for _ in range(250)} | {"a" * 6, "a" * 7, "a" * 8}
    counts = {w: rnd.choice((5, 6, 30, 160, 900)) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in spelling.variants(frame).collect()) == plain_variants(counts)


def test_every_pair_is_named_once(spark):
    words = ["abcdef", "abcdeg", "abcdefg", "bcdefg", "abdcef", "aabcdef", "xabcdef", "aaaaaaa", "aaaaaa", "aaaaaaaa"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    pairs = [frozenset(r) for r in spelling.near_pairs(frame).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((u, v)) for u in words for v in edits(u, set("".join(words))) if v in words and v != u}


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_spelling_odd_rows(spark):
    rnd = random.Random(9)
    names = ["Straßen", "ÉCOLES", "colours", "COLOUR", "naïvetés", "grey×grey", "short"]
    rows = [(None, " ".join(names * 5)), (0, None), (1, ""), (2, "12 _"), (3, "Ünïcode𝄞Ünïcode " * 6), (3, "Ünïcode𝄞Ünïcode " * 6), (4, "longest " * 100_000)]
    rows += [(k, " ".join(rnd.choice(names) for _ in range(80))) for k in range(5, 500)]
    docs = spark.createDataFrame([(*r, "w", 2) for r in rows], "doc_id long, text string, word string, n int")
    assert sorted(tuple(r) for r in spelling.grouped(docs).collect()) == plain_variants(plain_words(rows))
    assert spelling.grouped(docs.limit(0)).collect() == []


def test_a_common_chunk_splits(spark):
    """Words that share an ending meet only where most of their letters agree."""
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abcdefghijklmnop") for _ in range(4)) + "tion" for _ in range(3000)}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    largest = spelling.chunk_keys(frame, 0).groupBy("key").count().agg(F.max("count")).scalar()
    assert frame.select(largest.alias("m")).first()["m"] < 60
