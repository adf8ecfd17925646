"""Mixing, sharding and packing, and the pipeline as a whole."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from loomwell.llm import minhash, mixing, packing, sharding
from loomwell.llm.queries import MIX, QUERIES
from loomwell.operators.layout import exchange_count
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline


def lags(order, weights):
    """Largest distance of any source from its share while all sources still have blocks."""
    total, done, worst = sum(weights.values()), Counter(), 0
    for t, s in enumerate(order, 1):
        done[s] += 1
        worst = max(worst, *(abs(done[k] - t * w / total) for k, w in weights.items()))
    return worst


@pytest.mark.parametrize("weights", [[1, 1, 1], [120, 60, 30, 29, 1], [5, 3], [1], [10] * 24, [0.5, 0.25, 100]])
def test_every_source_stays_within_a_block(weights):
    slots = [4 * w for w in mixing.whole_weights(weights)]
    order = mixing.earliest_deadline_first(slots)
    assert Counter(order) == dict(enumerate(slots))
    assert lags(order, dict(enumerate(slots))) < 1


def test_mixed_order(spark):
    rows = [(k, None if k % 3 == 0 else "hot" if k % 3 == 1 else f"s{k % 5}", "z") for k in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, slot string")
    got = mixing.mixed(frame, {"hot": 3.0}, block_rows=4).collect()
    assert sorted((r["doc_id"], r["source"]) for r in got if r["source"]) == sorted(r[:2] for r in rows if r[1])
    assert len(got) == len(rows)
    blocks = {}
    for r in got:
        assert blocks.setdefault(r["slot"], (r["source"], r["block"])) == (r["source"], r["block"])
    assert sorted(blocks) == list(range(len(blocks)))
    full = Counter(r["slot"] for r in got)
    assert max(full.values()) == 4 and sum(n < 4 for n in full.values()) <= 7
    seen = Counter()
    for slot in sorted(blocks):
        source, block = blocks[slot]
        assert block == seen[source]
        seen[source] += 1
    _, _, slots = mixing.plan(sorted(Counter(r[1] for r in rows).items(), key=lambda x: (x[0] is not None, x[0] or "")), {"hot": 3.0}, 1.0, 4)
    first_end = min(-(-Counter(r[1] for r in rows)[s] // 4) / n for s, n in slots.items())
    start = [blocks[k][0] for k in range(int(first_end))]
    assert not start or lags(start, slots) < 1
    assert mixing.mixed(frame.limit(0)).collect() == []


@pytest.mark.parametrize(
    "weights", [[1] * 7, [1] * 21, [90] + [1] * 100, [0.5, 0.25, 100], [0.1, 0.7, 13.37], [120, 60, 30, 29, 1]]
)
def test_lag_against_the_given_weights(spark, weights):
    """Many rounds, in Spark, measured against the weights and not against whole slots."""
    named = {f"s{k:03}": w for k, w in enumerate(weights)}
    shares = [max(3, int(6000 * w / sum(weights))) for w in weights]
    rows = [(k, s) for s, n in zip(named, shares) for k in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mixed(frame, named, ("doc_id",), block_rows=1).orderBy("slot").collect()
    assert [r["slot"] for r in got] == list(range(len(rows)))
    total = sum(map(mixing.Fraction, map(str, weights)))
    exact = {s: mixing.Fraction(str(w)) for s, w in named.items()}
    until = int(min(n * total / exact[s] for s, n in zip(named, shares)))
    done = Counter()
    for t, r in enumerate(got[:until], 1):
        done[r["source"]] += 1
        assert all(abs(done[s] - t * w / total) < 1 for s, w in exact.items())


def test_stated_lags(spark, sf):
    """The registered query's shares and lags, worked out again from its order and the weights."""
    rows = QUERIES["op5_source_mixing"](spark, sf).collect()
    blocks = {r["slot"]: (r["source"], r["block"], r["share"], r["lag"]) for r in rows}
    assert sorted(blocks) == list(range(len(blocks)))
    sources = {b[0] for b in blocks.values()}
    total = sum(MIX.get(s, 1.0) for s in sources)
    done = Counter()
    left = Counter(b[0] for b in blocks.values())
    until = min(left[s] * total / MIX.get(s, 1.0) for s in sources)
    for slot in sorted(blocks):
        source, block, share, lag = blocks[slot]
        done[source] += 1
        assert share == pytest.approx(MIX.get(source, 1.0) / total) and block + 1 == done[source]
        if slot + 1 <= until:
            assert lag == pytest.approx(done[source] - (slot + 1) * share) and abs(lag) < 1
        else:
            assert lag is None
    assert len({round(b[2], 9) for b in blocks.values()}) > 2


def test_lag_after_sources_have_run_out():
    rnd = random.Random(8)
    for _ in range(100):
        weights = mixing.whole_weights([rnd.choice([1, 1, 3, 0.5, 7, 100]) for _ in range(rnd.randint(1, 8))])
        blocks = [rnd.choice([1, 5, 30, 300]) + rnd.randrange(5) for _ in weights]
        order = [None] * sum(blocks)
        for i, block, slot, step, slots, rounds in mixing.schedule(blocks, weights):
            for r in range(rounds):
                assert order[slot + r * slots] is None
                order[slot + r * slots] = i, block + r * step
        done = [0] * len(blocks)
        shares, left = [mixing.Fraction(0)] * len(blocks), set(range(len(blocks)))
        for i, block in order:
            assert block == done[i]
            done[i] += 1
            room = mixing.Fraction(1)
            while room and left:  # one slot of the ideal flow, source after source running out
                speed = sum(weights[j] for j in left)
                step = min(room / speed, *((blocks[j] - shares[j]) / weights[j] for j in left))
                for j in left:
                    shares[j] += step * weights[j]
                room -= step * speed
                left = {j for j in left if shares[j] < blocks[j]}
            assert all(abs(d - s) < 1 for d, s in zip(done, shares))


def test_many_sources(spark):
    rows = [(k, f"site{k % 700}") for k in range(5000)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string"), {"site1": 2.5}, block_rows=2).collect()
    assert sorted((r["doc_id"], r["source"]) for r in got) == rows
    blocks = {r["slot"]: (r["source"], r["block"]) for r in got}
    assert sorted(blocks) == list(range(len(blocks))) and len(set(blocks.values())) == len(blocks)
    assert Counter(blocks[s][0] for s in range(701))["site1"] in (2, 3)


def test_stored_order(spark):
    rows = [(k, f"s{k % 4}", f"t {k}", k) for k in range(400)] + [(5, "s1", "t 5", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, _place long")
    out = mixing.in_mixed_order(frame)
    assert out.columns == frame.columns
    got = [r["doc_id"] for r in out.collect()]
    place = {r["doc_id"]: (r["slot"], r["in_block"]) for r in mixing.mixed(frame.distinct()).collect()}
    assert sorted(got) == sorted(r[0] for r in rows)
    assert [Counter(rows[d][1] for d in got[k * 32 : (k + 1) * 32]).most_common(1)[0][1] for k in range(3)] == [9, 8, 8] or len(place) == 400


def test_shards(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    source = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = sharding.sharded(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(source)
    for r in rows:
        body = source[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 16, zlib.crc32(body), "bytes", None)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for held in by.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))


def test_rebalancing_moves_little_and_evens_out():
    rnd = random.Random(4)
    sizes = {s: rnd.randrange(1, 2000) for s in range(4000)}
    before = sharding.first_map(40, 4000)
    after = sharding.rebalanced(before, sizes, 40)
    full = Counter()
    for slot, shard in after.items():
        full[shard] += sizes.get(slot, 0)
    assert max(full.values()) - min(full.values()) < 0.001 * max(full.values())
    assert sum(before[s] != after[s] for s in before) < 0.25 * len(before)
    assert sharding.rebalanced(after, sizes, 40) == after


def test_map_versions(spark):
    from loomwell.session import scratch_path

    path = scratch_path(spark, "map")
    sharding.store_map(spark, path, 1, {0: 0, 1: 1})
    sharding.store_map(spark, path, 2, {0: 1, 1: 1})
    assert sharding.load_map(spark, path) == {0: 1, 1: 1} and sharding.load_map(spark, path, 1) == {0: 0, 1: 1}


def test_shards_of_odd_rows(spark):
    docs = [(1, None), (None, "é"), (2, "x"), (2, "x"), (3, "")]
    frame = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, shard int")
    rows = sharding.sharded(frame, 2).collect()
    assert sorted(r["size"] for r in rows) == [16, 16, 17, 17, 18]
    assert sharding.sharded(frame.limit(0)).collect() == []


def tokens(text):
    files = packing.tokenizer_files()
    tokens.model = getattr(tokens, "model", None) or Tokenizer.from_file(files[0])
    return tokens.model.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(docs, rows, window):
    """Every id lies in one piece, windows have no gaps, and order and checksums hold."""
    at = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= window for n in at.values())
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for i, text in docs:
        ids, done = tokens(text), 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert r["start"] == done and r["doc_tokens"] == len(ids)
            part = np.array(ids[done : done + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            done += r["length"]
        assert done == len(ids)
    return at


def test_packed_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs, *packing.tokenizer_files()).collect()
    at = check_pieces([(r["doc_id"], r["text"]) for r in docs.collect()], rows, packing.WINDOW)
    assert sum(at.values()) > 0.95 * packing.WINDOW * (len(at) - 8)


def test_packed_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "word " * 9000), (4, "x" * 30_000), (5, "Hello. There! You?\nYes.\n\nNo.  Two <|endoftext|> b"), (6, "a\x00b. c"), (None, "z")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start long")
    rows = packing.pack(frame, *packing.tokenizer_files(), window=64).collect()
    check_pieces(docs, rows, 64)
    assert packing.pack(frame.limit(0), *packing.tokenizer_files()).collect() == []
    twice = packing.pack(frame.filter("doc_id = 2").union(frame.filter("doc_id = 2")), *packing.tokenizer_files()).collect()
    assert len(twice) == 2


def test_encoders_agree():
    files = packing.tokenizer_files()
    encoder, rnd = packing.Encoder(*files), random.Random(7)
    parts = ["a", "Word", "é", "ß", "中", "😀", " ", " ", " ", "\n", "\t", ".", ". ", "!", "'s", "1", "12", "_", "\r", " ", "<|endoftext|>", "?\n"]
    for _ in range(2000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(12)))
        joined = b"".join(encoder.sentences(text)) + (1).to_bytes(4, "little")
        assert joined == np.array(tokens(text), "<u4").tobytes(), repr(text)


def test_cuts_are_the_cheapest():
    rnd = random.Random(9)
    for _ in range(200):
        at, penalty = [0], [0]
        for _ in range(rnd.randrange(1, 12)):
            at.append(at[-1] + rnd.randrange(1, 20))
            penalty.append(rnd.choice((0, 3, 9)))
        window = 32

        def cost(cuts):
            held = [0, *cuts]
            if any(at[b] - at[a] > window for a, b in zip(held, held[1:])):
                return None
            return sum(window - (at[b] - at[a]) + penalty[b] for a, b in zip(held, held[1:]))

        last = len(at) - 1
        options = [[k for k in range(1, last) if m >> k & 1] + [last] for m in range(0, 1 << last, 2)]
        best = min(c for o in options if (c := cost(o)) is not None)
        assert cost(packing.best_cuts(at, penalty, window)) == best


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == columns
        before, after = docs.count(), out.count()
        # at this size cut lines may leave no near copies, and every document some words
        assert after < before if name == "quality_rules" else after == before if name == "source_mixing" else after <= before
        docs = out
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    check_pieces([(r["doc_id"], r["text"]) for r in docs.collect()], rows, packing.WINDOW)
    stored = docs.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index")
    order = [r["doc_id"] for r in stored.collect()]
    first = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        first.setdefault(r["doc_id"], len(first))
    assert sorted(first, key=first.get) == order
    assert corpus_pipeline.run(spark, sf).count() == len(rows)


def test_pipeline_on_odd_rows(spark, tmp_path):
    text = " ".join(f"Word{k} is here." for k in range(40))
    docs = [(1, None), (2, ""), (3, text), (4, text), (None, text + " end"), (5, text.replace("Word1 ", "Other ")), (6, "x")]
    frame = spark.createDataFrame([(i, t, "en", None if i == 3 else "s", 3, "extra") for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long, key string")
    for rows in (frame, frame.limit(0)):
        held = rows
        for name, stage in corpus_pipeline.STAGES:
            held = corpus_pipeline.written(stage(spark, held, ""), f"odd-{name}")
        assert (held.count() == 0) == (rows is not frame)


def five_words(text):
    words = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def test_near_copies_go_although_their_lines_were_cut(spark, tmp_path):
    """Against all pairs of the texts before the cut; no fragment of a copy is left."""
    rnd = random.Random(2)
    words = [f"word{k}" for k in range(700)]
    docs = []
    for group in range(12):
        lines = [" ".join(rnd.choice(words) for _ in range(14)) for _ in range(12)]
        for copy in range(4 if group < 8 else 1):
            edited = list(lines)
            for _ in range(copy):
                k = rnd.randrange(12)
                edited[k] = " ".join(w if rnd.random() > 0.1 else rnd.choice(words) for w in edited[k].split())
            docs.append((len(docs), "\n".join(edited), "en", f"s{group % 3}", 1))
    long = "\n".join(" ".join(rnd.choice(words) for _ in range(20)) for _ in range(4000))
    docs += [(900, long, "en", "s0", 1), (901, docs[0][1], "en", "s1", 1), (901, docs[0][1], "en", "s1", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:2]:
        held = corpus_pipeline.written(stage(spark, held, str(tmp_path)), f"near-{name}")
    before = {r["doc_id"] for r in held.collect()}
    after = {r["doc_id"] for r in corpus_pipeline.dedup_near(spark, held, str(tmp_path)).collect()}
    sets = {d: five_words(t) for d, t, *_ in docs if d in before}
    group = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    assert after == {d for d in sets if group[d] == d} and len(after) < len(before)


def test_what_earlier_stages_did_counts_for_near_dedup(spark, tmp_path):
    """Texts that the cut has made alike are near copies; a text that the quality rules dropped is none."""
    rnd = random.Random(3)
    words = [f"word{k}" for k in range(900)]

    def block(n):
        return [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(n)]

    head, other, rest, own = block(6), block(6), block(9), block(9)
    # the same rest but for a word in every line, so that no line of it is cut
    like = [" ".join([f"other{k}", *line.split()[1:]]) for k, line in enumerate(rest)]
    junk = "\n".join([head[0]] * 30)
    docs = [(1, head), (2, other), (3, head + rest), (4, other + like), (5, own), (6, block(9))]
    docs = [(d, "\n".join(lines)) for d, lines in docs] + [(0, junk + " end"), (6, junk)]
    frame = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:2]:
        held = corpus_pipeline.written(stage(spark, held, str(tmp_path)), f"counts-{name}")
    assert {r["doc_id"] for r in held.collect()} == {1, 2, 3, 4, 5, 6} and held.filter("doc_id = 6").count() == 1
    sets = {r["doc_id"]: five_words(r["text"]) for r in held.collect()}
    whole = {d: five_words(t) for d, t in docs if d in (3, 4)}
    assert 100 * len(whole[3] & whole[4]) < 80 * len(whole[3] | whole[4])
    assert 100 * len(sets[3] & sets[4]) >= 80 * len(sets[3] | sets[4])
    assert {r["doc_id"] for r in corpus_pipeline.dedup_near(spark, held, str(tmp_path)).collect()} == {1, 2, 3, 5, 6}
    assert corpus_pipeline.uncut(spark, held, str(tmp_path)).filter("doc_id = 6").count() == 1


def test_near_dedup_moves_no_texts(spark, tmp_path, monkeypatch):
    """No search shuffles the texts it reads, however long the list of ids that are left, nor does what comes out."""
    rnd = random.Random(4)
    texts = [" ".join(f"word{rnd.randrange(900)}" for _ in range(80)) for _ in range(30)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(30 + k, t + " end") for k, t in enumerate(texts[:10])]
    docs += [(3, texts[3] + " twice"), (50, "junk"), (51, None), (None, texts[0])]
    frame = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet").filter("doc_id < 50 or doc_id is null")
    read = []
    for name in ("sketches", "full_sets"):
        monkeypatch.setattr(minhash, name, lambda texts, *a, f=getattr(minhash, name): read.append(exchange_count(texts)) or f(texts, *a))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.dedup_near(spark, held, str(tmp_path))
        assert read == [0] * 6 and exchange_count(out) == 0
        assert sorted(r["doc_id"] for r in out.filter("doc_id is not null").collect()) == sorted([*range(30), 3])
        assert out.filter("doc_id is null").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
