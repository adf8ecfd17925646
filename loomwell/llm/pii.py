"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what they miss.

The patterns find what is written by the book. The field labels whole spans: where
digits, @ signs or spelled-out addresses stand, every stretch of up to ``MAX_TOKENS``
tokens is a candidate for each kind, scored by features of the whole span (digits,
groups, checksum, octets, signs, and whether it reads as an address once its signs are
put back). Dynamic programming over the tokens, with spans of bounded length, picks
boundaries and kinds together. Its weights come from the patterns' own findings, in
their surroundings, as found and in altered spellings, against all other such stretches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwell.llm.common import bound_batches, written

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, MAX_CHARS = 9, 80
SAMPLE = 3000  # islands that the weights are fitted on
EPOCHS, RATE, RIDGE = 120, 0.5, 1e-3

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]\S*")
# between two tokens of one island: blanks, and up to two tokens of punctuation or a sign for an extension
GAP = re.compile(r"[ \t]{1,3}(?:(?:[^\w\s@]{1,3}|[Ee]xt\.?|x)[ \t]{1,3}){0,2}")
AT = re.compile(r"(?i)[ \t]*[\[({<][ \t]*(?:at|@)[ \t]*[\])}>][ \t]*|[ \t]*@[ \t]*|[ \t]+at[ \t]+")
DOT = re.compile(r"(?i)[ \t]*[\[({<][ \t]*dot[ \t]*[\])}>][ \t]*|[ \t]+dot[ \t]+|[ \t]+\.[ \t]*")
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# an address whose signs are bracketed, set apart or written as words; "at" alone only with "dot"
SPELLED = re.compile(
    r"(?i)(?<![\w.%+-])[a-z0-9._%+-]++(?:"
    r"[ \t]*+(?:[\[({<][ \t]*(?:at|@)[ \t]*[\])}>]|@)[ \t]*+[a-z0-9-]++"
    r"(?:(?:[ \t]*+\.|[ \t]*+[\[({<][ \t]*dot[ \t]*[\])}>]|[ \t]++dot(?=[ \t]))[ \t]*+[a-z0-9-]++)+"
    r"|[ \t]++at[ \t]++[a-z0-9-]++(?:[ \t]++dot[ \t]++[a-z0-9-]++)+)"
)
TOKEN, TOKEN_BEFORE, TOKEN_AFTER = re.compile(r"\S+"), re.compile(r"(\S+)[ \t]+$"), re.compile(r"\S*(?:[ \t]+\S+)?")
SPELLED_HINT = re.compile(r"(?i)@|\bdot\b")
DIGITS = re.compile(r"[0-9]+")
OPENING, CLOSING = "([{<\"'`", ".,;:!?)]}>\"'`"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGITS.findall(text))


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the local part reaches back to the last match at most."""
    done, at = 0, text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (found := DOMAIN.match(text, at + 1)):
                yield start, (done := found.end())
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The patterns' spans by kind, then start; matches that fail their check are dropped."""
    spans = [("email", s, e) for s, e in emails(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if octets(m.group())]
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return spans


def islands(text: str) -> Iterator[list[tuple[int, int]]]:
    """Stretches that may hold personal data, as lists of token spans.

    Tokens with a digit or an @ belong together if blanks alone, or few tokens of
    punctuation, lie between them. An address in any of the spellings of ``SPELLED``
    is taken with a token on either side, so that its boundaries are the field's choice.
    """
    places: list[tuple[int, int]] = []
    for found in HINT.finditer(text):
        start, end = found.span()
        low = places[-1][1] if places else 0
        while start > low and not text[start - 1].isspace():
            start -= 1
        if places and (gap := GAP.match(text, low)) and gap.end() == start:
            places[-1] = (places[-1][0], end)
        else:
            places.append((start, end))
    if SPELLED_HINT.search(text):
        for found in SPELLED.finditer(text):
            start, end = found.span()
            before = TOKEN_BEFORE.search(text, max(0, start - MAX_CHARS), start)
            after = TOKEN_AFTER.match(text, end)
            places.append((before.start(1) if before else start, after.end() if after else end))
        places.sort()
    low, high = -1, -1
    for start, end in [*places, (len(text) + 1, 0)]:
        if start > high:
            if high > low:
                yield [(low + m.start(), low + m.end()) for m in TOKEN.finditer(text[low:high])]
            low, high = start, end
        else:
            high = max(high, end)


def core(text: str, start: int, end: int) -> tuple[int, int]:
    """Without brackets and punctuation around; a leading bracket that closes inside stays."""
    while start < end and text[start] in OPENING and not (text[start] == "(" and ")" in text[start:end]):
        start += 1
    while end > start and text[end - 1] in CLOSING:
        end -= 1
    return start, end


FEATURES = 29


def features(span: str) -> list[int]:
    """Numbers of the features of a whole span, independent of its kind."""
    digits = digits_of(span)
    groups = [len(g) for g in DIGITS.findall(span)]
    joined = DOT.sub(".", AT.sub("@", span))
    letters = any(c.isalpha() for c in span)
    n = len(digits)
    edges = (0, 1, 4, 7, 9, 12, 13, 16, 20)
    on = [0, 1 + sum(n >= e for e in edges[1:])]  # 1..9
    tests = (
        letters,
        not letters and all(c in "0123456789 ().+-" for c in span),
        span.startswith("+"),
        "(" in span and ")" in span,
        13 <= n <= 19 and luhn(digits),
        13 <= n <= 19 and not luhn(digits),
        len(groups) == 4 and max(groups) <= 3 and octets(".".join(DIGITS.findall(span))),
        span.count(".") == 3,
        len(groups) > 1 and min(groups) == max(groups) == 4,
        groups[-2:] == [3, 4],
        span.count("@") == 1,
        span.count("@") == 1 and "." in span.partition("@")[2].strip("."),
        any(c in "=:/_#%" for c in span),
        len(groups) == 1,
        " " in span,
        "@" not in span and letters and n > 0,
        ADDRESS.fullmatch(joined),
        joined != span and "@" in joined,
        " " in joined,
    )
    return on + [10 + k for k, t in enumerate(tests) if t]


def candidates(text: str, chain: list[tuple[int, int]]) -> list[tuple[int, int, int, int, list[int]]]:
    """(first token, token after the last, start, end, features) of all spans of bounded length.

    No span begins or ends with punctuation alone, but for what opens a number.
    """
    out = []
    solid = [any(c.isalnum() for c in text[start:end]) for start, end in chain]
    for i in range(len(chain)):
        if not solid[i] and text[chain[i][0] : chain[i][1]] not in ("(", "+"):
            continue
        for j in range(i, min(i + MAX_TOKENS, len(chain))):
            if not solid[j]:
                continue
            start, end = core(text, chain[i][0], chain[j][1])
            if 0 < end - start <= MAX_CHARS:
                out.append((i, j + 1, start, end, features(text[start:end])))
    return out


def unsure(text: str) -> bool:
    """Whether a stretch passes a check that the patterns' finds pass, in a spelling that they miss.

    It may well be what the field is to find, so it says nothing about what is none.
    """
    checks = ({10 + 4}, {10 + 6, 10 + 7}, {10 + 16})  # checksum; octets and dots; address once its signs are put back
    chain = [m.span() for m in TOKEN.finditer(text)]
    return any(check <= set(on) for *_, on in candidates(text, chain) for check in checks)


def best_spans(text: str, chain: list[tuple[int, int]], weights: np.ndarray) -> list[tuple[str, int, int]]:
    """The likeliest segmentation; tokens outside spans score 0."""
    best: list[float] = [0.0] + [-np.inf] * len(chain)
    came: list = [None] * (len(chain) + 1)
    by_end: dict[int, list] = {}
    for c in candidates(text, chain):
        by_end.setdefault(c[1], []).append(c)
    for j in range(1, len(chain) + 1):
        best[j], came[j] = best[j - 1], (j - 1, None)
        for i, _, start, end, on in by_end.get(j, ()):
            scores = weights[:, on].sum(axis=1)
            kind = int(scores.argmax())
            if best[i] + scores[kind] > best[j]:
                best[j], came[j] = best[i] + scores[kind], (i, (KINDS[kind], start, end))
    spans, j = [], len(chain)
    while j:
        j, span = came[j]
        if span:
            spans.append(span)
    return spans[::-1]


def respelled(kind: str, span: str) -> list[str]:
    """A found span as it is, and as others might write it."""
    digits = digits_of(span)
    if kind == "phone":
        area, office, line = digits[-10:-7], digits[-7:-4], digits[-4:]
        signs = [f"({area}) {office}-{line}", f"({area})  {office} - {line}", f"( {area} ) {office} {line}"]
        return [span, span.lstrip("+"), *signs, *[sign.join((area, office, line)) for sign in ("-", ".", "  ", " - ")]]
    if kind == "card":
        fours = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [span, *[sign.join(fours) for sign in (" ", "-", ".", " - ", "  ")]]
    if kind == "ip":
        return [span, *[span.replace(".", sign) for sign in ("[.]", " . ", " [.] ")]]
    local, _, host = span.partition("@")
    signs = ((" [at] ", " [dot] "), (" (at) ", "."), (" @ ", "."), (" at ", " dot "), ("[at]", "[dot]"), (" @ ", " . "), ("@", " dot "))
    return [span, *[local + at + host.replace(".", dot) for at, dot in signs]]


def in_place(text: str, spans: list[tuple[str, int, int]], turn: int) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """An island with one of its spans respelled at a time, the rest of it as it is, and where its spans are then.

    Each span is used as found and in two other spellings, which take turns from sample to sample.
    """
    for n, (kind, start, end) in enumerate(spans):
        found, *others = respelled(kind, text[start:end])
        for spelling in (found, *[others[(2 * turn + k) % len(others)] for k in (0, 1)]):
            more = len(spelling) - (end - start)
            body = text[:start] + spelling + text[end:]
            moved = [(k, s + more * (s >= end), e + more * (s >= end)) for m, (k, s, e) in enumerate(spans) if m != n]
            yield body, [(k, *core(body, s, e)) for k, s, e in [*moved, (kind, start, start + len(spelling))]]


def fit(samples: list[tuple[str, list[tuple[str, int, int]]]]) -> np.ndarray:
    """Weights that maximise the likelihood of the labelled segmentations, less a ridge.

    A sample is an island's text and its spans. Gradients are observed minus
    expected feature counts; expectations come from the forward and backward sums
    over all segmentations.
    """
    weights = np.zeros((len(KINDS), FEATURES))
    weights[:, 0] = -2.0
    rows, facts, observed = [], [], np.zeros_like(weights)
    for text, spans in samples:
        chain = [m.span() for m in TOKEN.finditer(text)]
        held = candidates(text, chain)
        wanted = {(s, e): KINDS.index(k) for k, s, e in spans}
        rows.append((len(chain), [(i, j) for i, j, *_ in held], len(facts)))
        done: set[tuple[int, int]] = set()
        for i, j, start, end, on in held:
            if (start, end) in wanted and (start, end) not in done:
                done.add((start, end))
                observed[wanted[start, end], on] += 1
            line = np.zeros(FEATURES)
            line[on] = 1
            facts.append(line)
    if not facts or not observed.any():
        weights[:, 0] = -1e9
        return weights
    matrix = np.array(facts)
    step = np.zeros_like(weights)
    for _ in range(EPOCHS):
        scores = np.exp(np.clip(matrix @ weights.T, -30, 30))  # candidate, kind
        any_kind = scores.sum(axis=1)
        chance = np.zeros(len(facts))
        for tokens, places, at in rows:
            forward, backward = [1.0] + [0.0] * tokens, [0.0] * tokens + [1.0]
            by_end: dict[int, list] = {}
            by_start: dict[int, list] = {}
            for k, (i, j) in enumerate(places):
                by_end.setdefault(j, []).append((i, any_kind[at + k]))
                by_start.setdefault(i, []).append((j, any_kind[at + k]))
            for j in range(1, tokens + 1):
                forward[j] = forward[j - 1] + sum(forward[i] * s for i, s in by_end.get(j, ()))
            for i in range(tokens - 1, -1, -1):
                backward[i] = backward[i + 1] + sum(backward[j] * s for j, s in by_start.get(i, ()))
            for k, (i, j) in enumerate(places):
                chance[at + k] = forward[i] * backward[j] / forward[-1]
        expected = (scores * chance[:, None]).T @ matrix
        slope = (observed - expected) / len(rows) - RIDGE * weights
        step = 0.9 * step + RATE * slope
        weights += step
    return weights


FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("base", T.ArrayType(T.StringType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("islands", T.ArrayType(T.StringType())),
    ]
)
ADDED = T.StructType([*FOUND.fields[:2], T.StructField("added", T.ArrayType(T.StringType()))])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the patterns' spans as ``kind:start:end``, and the islands with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, starts, bodies = [], [], []
            for body in batch.column(1).to_pylist():
                body = body or ""
                hint = HINT.search(body)
                base.append([f"{k}:{s}:{e}" for k, s, e in base_spans(body)] if hint else [])
                chains = list(islands(body))
                starts.append([c[0][0] for c in chains])
                bodies.append([body[c[0][0] : c[-1][1]] for c in chains])
            columns = [batch.column(0), pa.array(base, pa.list_(pa.string())), pa.array(starts, pa.list_(pa.int64())), pa.array(bodies, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=FOUND.names)

    bound_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, FOUND)


def read_spans(spans: list[str]) -> list[tuple[str, int, int]]:
    return [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in spans)]


def learn(found: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Fit on at most ``sample`` islands: those whose document and place hash lowest.

    An island with a span of the patterns is used as found and in other spellings; one
    without teaches what is no personal data. Islands over 200 characters are left out.
    """
    spread = found.select("doc_id", "base", F.inline(F.arrays_zip("starts", "islands"))).filter(F.length("islands") <= 200)
    spread = spread.withColumn("hit", F.exists("base", lambda b: F.split(b, ":")[1].cast("long").between(F.col("starts"), F.col("starts") + F.length("islands"))))
    by_hash = F.xxhash64("doc_id", "starts")
    samples = []
    for hit in (True, False):
        for row in spread.filter(F.col("hit") == hit).orderBy(by_hash).limit(sample // 2).collect():
            text, at = row["islands"], row["starts"]
            inside = [(k, s - at, e - at) for k, s, e in read_spans(row["base"]) if at <= s and e <= at + len(text)]
            if not inside and not unsure(text):
                samples.append((text, []))
            samples += in_place(text, inside, len(samples))
    return fit(samples)


def add_spans(found: DataFrame, weights: np.ndarray) -> DataFrame:
    """Decode the islands; spans that touch one of the patterns' are dropped, theirs stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            added = []
            for row in rows:
                held = read_spans(row["base"])
                more = []
                for at, body in zip(row["starts"], row["islands"]):
                    chain = [m.span() for m in TOKEN.finditer(body)]
                    for kind, s, e in best_spans(body, chain, weights):
                        if all(e + at <= a or b <= s + at for _, a, b in held):
                            more.append(f"{kind}:{s + at}:{e + at}")
                added.append(more)
            columns = [batch.column(0), batch.column(1), pa.array(added, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=ADDED.names)

    return found.mapInArrow(run, ADDED)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``added``: spans as ``kind:start:end`` in code points, end exclusive.

    One row per input row, equal rows included; NULL ids stay NULL, a NULL text is
    empty and has no span. Other columns are ignored. Texts are read once.
    """
    found = written(scan(docs, doc_id, text), "pii-found")
    return add_spans(found, learn(found))


def reported(docs: DataFrame) -> DataFrame:
    """The registered query: counts per kind and digest of the patterns' spans, and all spans."""

    def parts(span):
        return F.split(span, ":")

    def place(span):
        kind = F.array_position(F.array(*map(F.lit, KINDS)), parts(span)[0])
        return F.struct(kind.alias("kind"), parts(span)[1].cast("long").alias("start"), span.alias("span"))

    every = F.transform(F.sort_array(F.transform(F.concat("base", "added"), place)), lambda e: e["span"])

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in KINDS]
    return personal_data(docs).select(
        "doc_id", *counts, F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans")
    )
