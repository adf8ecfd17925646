"""Quality rules, line dedup, personal data, language and URLs against plain Python."""

import random
import re
import zlib
from collections import Counter
from hashlib import sha256
from math import exp, log

import numpy as np
import pytest
from compare import connect, differences
from loomwell.llm import lang_id, line_dedup, pii, quality, url_filter
from loomwell.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ["op8_quality_rules", "quality_ablations"])
def test_quality_equals_its_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None


def test_quality_odd_rows(spark):
    clean = " ".join(f"word{k}" for k in range(60))
    docs = [(1, None), (2, ""), (3, "\x0b\r\f"), (4, clean), (4, clean), (None, clean), (5, "la la la " * 30_000), (6, clean + " #$%&" * 4)]
    frame = spark.createDataFrame([(*d, 1, "m") for d in docs], "doc_id long, text string, n_words long, m string")
    rows = {r["doc_id"]: r for r in quality.judged(frame).collect()}
    assert quality.judged(frame).count() == len(docs)
    assert rows[1]["n_words"] == rows[2]["n_words"] == rows[3]["n_words"] == 0 and rows[1]["base_failed"]
    assert rows[4]["kept"] and rows[None]["kept"] and not rows[6]["kept"] and not rows[6]["base_failed"]
    assert rows[5]["n_repeat_words"] == rows[5]["n_words"] == 90_000
    assert quality.keep_passing(frame).columns == frame.columns and quality.keep_passing(frame).count() == 3
    assert quality.judged(frame.limit(0)).collect() == []


def test_windows_overlap_once(spark):
    frame = spark.createDataFrame([(1, "a b a b a b x y"), (2, "q a b c r a b c s")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_repeat_words"] for r in quality.judged(frame).collect()} == {1: 6, 2: 6}


def test_ablations_add_up(spark, sf):
    ledger = quality.rule_ledger(spark.read.parquet(f"{sf}/documents.parquet"))
    bits = [r["failed"] for r in ledger.collect()]
    names = quality.POLICIES[quality.CURRENT]
    every = quality.mask(names)
    for r in quality.ablations(ledger).collect():
        bit = quality.mask((r["rule"],))
        assert r["fails"] == sum(b & bit != 0 for b in bits)
        assert r["only"] == sum(b & every == bit for b in bits)
        assert r["kept_without"] == sum(b & (every ^ bit) == 0 for b in bits)


def cut(docs, min_words):
    """Delete every line in a run of enough words that occurs at an earlier place."""
    order = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is not None, d[0] or 0))
    seqs = []
    for d in order:
        lines = [(j, x.strip(" \t\x0b\f\r")) for j, x in enumerate(d[1].split("\n"))]
        seqs.append([(j, x) for j, x in lines if x])
    first, gone = {}, {d: set() for d in order}
    for n, seq in enumerate(seqs):
        for i in range(len(seq)):
            for e in range(i + 1, len(seq) + 1):
                run = tuple(x for _, x in seq[i:e])
                if first.setdefault(run, (n, i)) != (n, i) and sum(len(re.findall("[^ \t-\r]+", x)) for x in run) >= min_words:
                    gone[order[n]].update(j for j, _ in seq[i:e])
    return [None if d[1] is None else "\n".join(x for j, x in enumerate(d[1].split("\n")) if j not in gone[d]) for d in docs]


@pytest.mark.parametrize("seed", range(3))
def test_line_runs(spark, seed):
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choice("abcdefgh") * 3 for _ in range(rnd.choice((1, 2, 3, 4, 6)))) for _ in range(7)]
    docs = []
    for k in range(25):
        lines = [rnd.choice(pool) if rnd.random() < 0.85 else f"own line {k} {n}" for n in range(rnd.randrange(1, 12))]
        if rnd.random() < 0.3:
            lines.insert(rnd.randrange(len(lines)), rnd.choice(("", "  ")))
        docs.append((k, "\n".join(lines)))
    docs += [(100, None), (101, ""), (102, "\n"), (103, pool[0] + " ")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, gone string")
    got = {r["_row"]["doc_id"]: r["_text"] for r in line_dedup.without_repeats(frame, min_words=6).collect()}
    assert [got[d[0]] for d in docs] == cut(docs, 6)


def test_line_dedup_odd_rows(spark):
    long = "\n".join(f"line number {k} of a very long text with more than ten words in it" for k in range(3000))
    docs = [(1, "same words in this line that are more than ten of them"), (1, "same words in this line that are more than ten of them"), (None, long), (2, long), (3, long + "\ntail")]
    frame = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, key long")
    rows = line_dedup.deduplicated(frame)
    assert rows.columns == frame.columns
    assert sorted((str(r["doc_id"]), len(r["text"])) for r in rows.collect()) == [("1", len(docs[0][1]))] * 2 + [("3", 4), ("None", len(long))]
    assert line_dedup.deduplicated(frame.limit(0)).collect() == []


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checksum(digits):
    doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_spans(text):
    number = lambda m: re.sub("[^0-9]", "", m.group())
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(number(m)) <= 19 and checksum(number(m))]
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(number(m)) <= 15]


def test_base_spans_equal_the_patterns():
    rnd = random.Random(1)
    parts = ["a@b.c", "1.2.3.4", "256.1.1.1", "4111 1111-1111 1111", "4111111111111111", "+1 (212) 555-0100", "+", "@", ".", "-", " ", "x", "é", "00012.1.1.1", "9" * 25, "_", "%", "\n", "٣"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_personal_data(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in pii.reported(table).collect()}
    for r in table.select("doc_id", "text").collect():
        spans = plain_spans(r["text"] or "")
        got = rows[r["doc_id"]]
        assert got["base_sha256"] == sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        assert [got[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        every = pii.read_spans(got["spans"].split(",")) if got["spans"] else []
        assert set(spans) <= set(every)
        assert every == sorted(every, key=lambda s: (pii.KINDS.index(s[0]), s[1]))


SEVEN = {
    "call (212) 555 - 0199 now": "phone:5:21",
    "card 4111 - 1111 - 1111 - 1111 ok": "card:5:30",
    "host 10 . 0 . 0 . 7 down": "ip:5:19",
    "call (212)  555-0199 now": "phone:5:20",
    "card 4111  1111  1111  1111 ok": "card:5:27",
    "write to jane [at] mail [dot] org today": "email:9:33",
    "write to jane @ mail.org today": "email:9:24",
}


def test_islands_hold_whole_spellings():
    for text, span in SEVEN.items():
        start, end = map(int, span.split(":")[1:])
        assert any(chain[0][0] <= start and end <= chain[-1][1] for chain in pii.islands(text)), text
    assert list(pii.islands("no such thing at all, dot")) == [] and list(pii.islands("")) == []
    chains = list(pii.islands("1 2 word 3\n4 - - 5 - - - 6"))
    assert [(c[0][0], c[-1][1]) for c in chains] == [(0, 3), (9, 10), (11, 18), (25, 26)]
    long = "9" * 300_000
    assert [len(c) for c in pii.islands(long + " x")] == [1] and pii.candidates(long, [(0, len(long))]) == []


def test_best_spans_against_all_segmentations():
    rnd = random.Random(6)
    for _ in range(60):
        text = " ".join(rnd.choice(["12", "a@b.c", "-", "(212)", "555", "x", "10.0.0.1", "at", "dot"]) for _ in range(rnd.randrange(1, 7)))
        chain = [m.span() for m in re.finditer(r"\S+", text)]
        weights = np.array([[rnd.uniform(-1, 0.8) for _ in range(pii.FEATURES)] for _ in pii.KINDS])
        held = {}
        for i, j, start, end, on in pii.candidates(text, chain):
            held[i, j] = (weights[:, on].sum(axis=1).max(), start, end)

        def best(at):
            if at == len(chain):
                return 0.0, []
            options = [best(at + 1)]
            for j in range(at + 1, len(chain) + 1):
                if (at, j) in held:
                    score, start, end = held[at, j]
                    rest = best(j)
                    options.append((score + rest[0], [(start, end), *rest[1]]))
            return max(options, key=lambda o: o[0])

        assert [s[1:] for s in pii.best_spans(text, chain, weights)] == best(0)[1]


def personal_corpus(rnd, n):
    number = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 8)))
    docs = []
    for k in range(n):
        card = number(15)
        card += next(c for c in "0123456789" if checksum(card + c))
        thing = rnd.choice(
            [f"+1 ({number(3)}) {number(3)}-{number(4)}", f"{rnd.randrange(256)}.{rnd.randrange(256)}.1.9", f"{word()}{number(2)}@{word()}.org", f"{word()}.{word()}@mail.{word()}.com",
             card, f"version 2.{number(1)}", f"in {number(4)}", f"id={number(9)}x", f"{number(2)} - {number(3)} words", f"at {number(2)} . Then", f"{number(5)}, {number(6)} and {number(7)}"]
        )
        docs.append((k, f"{word()} {word()} {thing} {word()} {word()}"))
    return docs, number, word


def test_added_spans_are_right_and_few_are_missed(spark):
    """Spellings in texts that the field was not fitted on, among numbers that are nobody's."""
    rnd = random.Random(12)
    docs, number, word = personal_corpus(rnd, 900)
    wanted, rows = {}, list(docs)
    for k in range(5000, 5400):
        card = number(15)
        card += next(c for c in "0123456789" if checksum(card + c))
        fours = [card[i : i + 4] for i in range(0, 16, 4)]
        kind, thing = rnd.choice(
            [("phone", f"({number(3)}) {number(3)} - {number(4)}"), ("phone", f"({number(3)})  {number(3)}-{number(4)}"), ("card", " - ".join(fours)), ("card", "  ".join(fours)),
             ("ip", f"10 . {rnd.randrange(256)} . 0 . 7"), ("ip", f"172[.]16[.]0[.]{rnd.randrange(256)}"), ("email", f"{word()} [at] {word()} [dot] org"), ("email", f"{word()} @ {word()}.net"),
             ("email", f"{word()} at {word()} dot com"), (None, f"{number(4)} - {number(4)}"), (None, f"at {number(2)}, dot"), (None, f"{number(2)} . {number(1)}"), (None, "meet at noon, dot the i")]
        )
        text = f"{word()} {word()} {thing} {word()} {word()}"
        rows.append((k, text))
        start = text.index(thing)
        wanted[k] = [f"{kind}:{start}:{start + len(thing)}"] if kind else []
    rows += [(9000 + n, t) for n, t in enumerate(SEVEN)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    added = {r["doc_id"]: r["added"] for r in pii.personal_data(frame).collect()}
    assert [added[9000 + n] for n in range(len(SEVEN))] == [[s] for s in SEVEN.values()]
    right = sum(len(set(added[k]) & set(w)) for k, w in wanted.items())
    assert right >= 0.95 * sum(map(len, wanted.values())), "recall"
    assert right >= 0.95 * sum(len(added[k]) for k in wanted), "precision"


def test_field_adds_other_spellings(spark):
    rnd = random.Random(2)
    number = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    docs = []
    for k in range(400):
        thing = rnd.choice([f"+1 ({number(3)}) 555-{number(4)}", f"{rnd.randrange(256)}.{rnd.randrange(256)}.1.9", f"u{number(2)}@mail.example.org", f"version 2.{number(1)}", f"in {number(4)}", f"id={number(9)}x"])
        docs.append((k, f"some words {thing} and more words"))
    docs += [(1000, "call (212) 555-0199 now"), (1001, "host 10[.]0[.]0[.]7 is down"), (1002, "in 1999 there were 12 of them"), (1003, None), (None, "x 5"), (1003, "")]
    frame = spark.createDataFrame([(*d, "b") for d in docs], "doc_id long, text string, base string")
    rows = [r for r in pii.personal_data(frame).collect() if (r["doc_id"] or 0) >= 1000]
    added = {r["doc_id"]: r["added"] for r in rows if r["doc_id"] != 1003}
    assert added[1000] == ["phone:5:19"] and added[1001] == ["ip:5:19"] and added[1002] == []
    assert all(r["base"] == [] and r["added"] == [] for r in rows if r["doc_id"] == 1003)
    assert pii.personal_data(frame.limit(0)).collect() == []


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = lang_id.predicted(docs).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)


def test_language_odd_rows(spark):
    docs = [(1, "the cat and the dog", "en"), (3, "der hund und die katze", "de"), (4, None, "en"), (5, "123 !", "en"), (6, "", None), (None, "und der", "de"), (7, "der die " * 200_000, None), (8, "a", "en")]
    frame = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, lang string, score double")
    rows = {r["doc_id"]: r for r in lang_id.predicted(frame).collect()}
    assert [rows[k]["lang_pred"] for k in (4, 5, 6)] == ["und"] * 3 and rows[7]["lang_pred"] == "de" and rows[None]["held_out"] is False
    assert lang_id.predicted(frame.limit(0)).collect() == []
    blank = frame.filter("doc_id > 100").union(frame.filter("doc_id = 6"))
    assert [r["lang_pred"] for r in lang_id.predicted(blank).collect()] == ["und"]


def plain_bayes(docs, texts):
    """Naive Bayes by the book over the same hashed n-grams, one order after the other, in plain Python."""

    def grams(text):
        codes = [0, *map(ord, text.lower()), 0]
        for at, order in enumerate(lang_id.ORDERS):
            for k in range(len(codes) - order + 1):
                mixed = 0
                for c in codes[k : k + order]:
                    mixed = (mixed + c + 1) * 0x9E3779B97F4A7C15 % 2**64
                    mixed ^= mixed >> 29
                yield at, mixed >> 64 - lang_id.BUCKET_BITS

    langs = sorted({lang for lang, _ in docs})
    counts = {lang: Counter(g for name, t in docs if name == lang for g in grams(t)) for lang in langs}
    totals = {(lang, at): sum(n for (o, _), n in counts[lang].items() if o == at) for lang in langs for at in range(len(lang_id.ORDERS))}
    rows = Counter(lang for lang, _ in docs)
    out = []
    for text in texts:
        logs = {}
        for lang in langs:
            likely = 0.0
            for at, bucket in grams(text):
                likely += log((counts[lang][at, bucket] + lang_id.SMOOTHING) / (totals[lang, at] + lang_id.SMOOTHING * 2**lang_id.BUCKET_BITS))
            logs[lang] = log(rows[lang] / len(docs)) + likely / len(lang_id.ORDERS)
        top = max(logs.values())
        best = next(lang for lang in langs if logs[lang] == top)
        out.append((best, 1 / sum(exp(x - top) for x in logs.values())))
    return out


def test_language_against_plain_bayes(spark):
    rnd = random.Random(4)
    words = {"en": "the cat and dog of this house".split(), "de": "der hund und die katze im haus".split(), "fr": "le chat et la maison été".split()}
    docs = [(lang, " ".join(rnd.choice(words[lang]) for _ in range(rnd.randrange(1, 12)))) for lang in ("en", "en", "de", "fr") for _ in range(10)]
    texts = [" ".join(rnd.choice(words[rnd.choice(list(words))]) for _ in range(rnd.randrange(1, 5))) for _ in range(60)]
    model = lang_id.learn(spark.createDataFrame(docs, "lang string, text string"))
    got = lang_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r, (best, score) in zip(sorted(got, key=lambda r: r["doc_id"]), plain_bayes(docs, texts)):
        assert r["lang_pred"] == best and r["score"] == pytest.approx(score, abs=2e-4)


def test_language_ties_go_to_the_first_name(spark):
    docs = [(lang, "la la") for lang in ("b", "a", "c")]
    model = lang_id.learn(spark.createDataFrame(docs, "lang string, text string"))
    assert lang_id.guess("la", model) == ("a", pytest.approx(1 / 3))


def test_language_blocks_change_nothing(monkeypatch):
    text = "abcde äö x" * 50
    whole = sorted(sum((b.tolist() for b in lang_id.buckets(text)), []))
    monkeypatch.setattr(lang_id, "BLOCK", 64)
    assert sorted(sum((b.tolist() for b in lang_id.buckets(text)), [])) == whole


def plain_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host) :]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in url_filter.RULES:
        site, start = rule.split("/", 1)
        if (host == site or host.endswith("." + site)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_url_rules_and_scores(spark):
    urls = ["HTTP://A.Example.NET/en/x?y#z", "https://example.net/en", "a.net", None, "", "x://net", "x://net/", "x://y.org/fr/", "x://Ünet.ORG/fr/a", "http://h.com?a=://net/", "x://net\n/en", "x://planet/", "x://example.com/de/1", "://net/", "x://s.example.com/de/"]
    urls += [f"http://good{k}.org/fr/{k}" for k in range(60)] + [f"http://spam{k}.net/{k}" for k in range(60)] + ["http://goods.com/fr/7", "http://spam77.com/7"]
    frame = spark.createDataFrame([(k, u, "r", "k") for k, u in enumerate(urls)], "page_id long, url string, rule string, kind string")
    rows = sorted(url_filter.judged(frame).collect())
    assert [(r["host"], r["path"], r["rule"]) for r in rows] == [plain_rule(u)[:3] for u in urls]
    assert all(r["verdict"] == plain_rule(u)[3] for r, u in zip(rows, urls) if r["rule"])
    assert [r["verdict"] for r in rows[-2:]] == ["allow", "block"]
    assert rows[3]["score"] == 0.0 and rows[3]["verdict"] in ("allow", "block")
    assert url_filter.judged(frame.limit(0)).collect() == []


def test_url_models_are_distributions(spark):
    frame = spark.createDataFrame([("allow", "http://a.org/fr/1"), ("block", "http://b.net/2"), ("allow", "http://c.org/fr/3")], "kind string, url string")
    model = url_filter.train(frame)["allow"]
    from math import exp

    for context in ("", "\x01" * 4, "http", "rg/f", "zzzz"):
        text = "\x01" * 0 + context.rjust(4, "\x01")
        total = sum(exp(url_filter.log_likelihood(text[-4:] + chr(c), model)) for c in range(128))
        assert total == pytest.approx(1, abs=1e-9)


def test_url_models_keep_rare_grams(spark):
    """Over 65,536 characters a class, URLs seen once still count in full, and scores equal the plain ones."""
    urls = [f"http://h{k % 900}.org/fr/{k * 7919 % 100_003}" for k in range(4000)]
    urls += [f"http://g{k % 700}.net/{k * 104_729 % 99_991}" for k in range(4000)]
    rare = "http://quokka.org/fr/zyxw"
    urls += [f"{rare}{k}" for k in range(3)] + ["http://quokka.com/zyxw", "http://zebra.com/", None, "", "http://zebra.com/"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.judged(frame).collect()
    assert sorted(r["page_id"] for r in rows) == list(range(len(urls)))
    fold = F.pmod(F.xxhash64("url"), F.lit(url_filter.HELD_OUT))
    models = url_filter.train(url_filter.ruled(frame).filter("kind IS NOT NULL").filter(fold > 0))
    assert models["allow"][""][0] > url_filter.SHARE and "zyxw" in models["allow"]
    for r in rows[::97] + rows[-9:]:
        assert r["score"] == pytest.approx(url_filter.score(urls[r["page_id"]], models), abs=1e-9)
    by = {r["page_id"]: r["score"] for r in rows}
    for k in range(len(urls) - 8, len(urls)):
        assert by[k] == pytest.approx(url_filter.score(urls[k], models), abs=1e-9)
