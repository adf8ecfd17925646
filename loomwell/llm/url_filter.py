"""URL filter: host rules first, then a ratio of two character language models.

Two variable-order Markov models, one of accepted and one of rejected URLs, are
counted from the URLs that the rules decide. A character's probability blends its
counts after the longest context seen with the next shorter one (Witten-Bell). All
counts stay, in a table: the distinct grams of the URLs to score are joined to it, one
order after the other. Frequent grams (at most ``SHARE``) are broadcast to the scoring,
the rest is joined. The score is the difference of the two log likelihoods per
character; the threshold is calibrated on decided URLs that the counts did not see.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwell.llm.common import bound_batches, whole, written

# (verdict, host and path): a rule holds for the host and its subdomains
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 4
SHARE = 1 << 16  # a gram is broadcast if at least one in so many is equal to it
UNIT = 1 << 40  # log likelihoods are added up as whole numbers, so that order does not matter
ALPHABET = 128
BINS, SPAN = 400, 8.0  # scores between -SPAN and SPAN
HELD_OUT = 5  # one in so many decided URLs calibrates

GRAMS = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())]
)
PARTS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("gram", T.StringType()),
        T.StructField("times", T.LongType()),
        T.StructField("held", T.LongType()),
    ]
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From the first :// to a slash, question mark, hash or the end; empty without ://."""
    return ascii_lower(F.regexp_extract(whole(url), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole(url), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (the longest that fits, else NULL) and ``kind``, its verdict."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        site, _, start = rule.partition("/")
        on_host = (F.col("host") == site) | F.col("host").endswith("." + site)
        fits.append((verdict, rule, on_host & F.col("path").startswith("/" + start)))
    rule = kind = F.lit(None).cast("string")
    for verdict, name, fit in reversed(fits):
        rule, kind = F.when(fit, name).otherwise(rule), F.when(fit, verdict).otherwise(kind)
    placed = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return placed.withColumns({"rule": rule, "kind": kind})


def symbols(url: str) -> str:
    """What the models read: lower case, characters beyond ASCII as one symbol, after start marks."""
    return "\x01" * ORDER + "".join(c if c < "\x7f" else "\x7f" for c in url.lower())


def grams(decided: DataFrame, least: int = 0) -> DataFrame:
    """``kind``, ``gram`` and ``n``: the counts of contexts with their next character, for every order from ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, Counter] = {}
            for kind, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, text = sums.setdefault(kind, Counter()), symbols(url)
                for k in range(ORDER, len(text)):
                    held.update([text[k - o : k + 1] for o in range(least, ORDER + 1)])
            for kind, held in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(held)), pa.array(list(held)), pa.array(list(held.values()), pa.int64())],
                    names=GRAMS.names,
                )

    bound_batches(decided.sparkSession)
    return decided.select("kind", "url").mapInArrow(run, GRAMS).groupBy("kind", "gram").agg(F.sum("n").alias("n"))


def model_table(decided: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram`` and ``value``: log likelihood as accepted less that as rejected, in ``UNIT``, for all wanted grams.

    A context has at most ALPHABET different successors, so no join here has a hot key.
    """
    kinds = ("allow", "block")
    counts = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)) for k in kinds}
    counted = written(grams(decided).groupBy("gram").agg(*[c.alias(k) for k, c in counts.items()]), "url-grams")
    context = F.expr("left(gram, length(gram) - 1)")
    sums = [F.sum(k).alias(f"{k}_n") for k in kinds] + [F.count_if(F.col(k) > 0).alias(f"{k}_types") for k in kinds]
    contexts = counted.groupBy(context.alias("context")).agg(*sums)
    tails = F.explode(F.array(*[F.expr(f"right(gram, {o + 1})") for o in range(ORDER + 1)]))
    asked = wanted.select(tails.alias("gram")).distinct().withColumn("context", context)
    facts = written(asked.join(counted, "gram", "left").join(contexts, "context", "left"), "url-facts")

    def blended(k: str, lower: Column) -> Column:
        n, types = F.col(f"{k}_n"), F.col(f"{k}_types")
        return F.when(n > 0, (F.coalesce(k, F.lit(0)) + types * lower) / (n + types)).otherwise(lower)

    at = facts.filter(F.length("gram") == 1).select("gram", *[blended(k, F.lit(1 / ALPHABET)).alias(f"{k}_p") for k in kinds])
    for o in range(1, ORDER + 1):
        longer = facts.filter(F.length("gram") == o + 1).withColumn("tail", F.expr(f"right(gram, {o})"))
        at = longer.join(at.withColumnRenamed("gram", "tail"), "tail").select(
            "gram", *[blended(k, F.col(f"{k}_p")).alias(f"{k}_p") for k in kinds]
        )
    return at.select("gram", F.round((F.log("allow_p") - F.log("block_p")) * UNIT).cast("long").alias("value"))


def url_key(url: Column) -> Column:
    return F.md5(whole(url).cast("binary"))


def scored(pages: DataFrame, decided: DataFrame) -> DataFrame:
    """``key`` and ``score`` of every distinct URL that is not empty, by the models of the decided ones."""
    urls = written(pages.filter("url <> ''").select("url").distinct(), "urls")
    wanted = written(grams(urls.select(F.lit("").alias("kind"), "url"), ORDER).select("gram", "n"), "url-wanted")
    values = written(wanted.join(model_table(decided, wanted), "gram"), "url-values")
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") >= max(1, -(-total // SHARE))
    hot = {r["gram"]: r["value"] for r in values.filter(often).select("gram", "value").collect()}  # at most SHARE
    held = pages.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, out = held.value, []
            for key, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text, rest, here = symbols(url), Counter(), 0
                for k in range(ORDER, len(text)):
                    value = known.get(gram := text[k - ORDER : k + 1])
                    if value is None:
                        rest[gram] += 1
                    else:
                        here += value
                # a URL's own sum goes under its key, which no gram equals
                out.append((key, key, 1, here))
                out += [(key, gram, n, None) for gram, n in rest.items()]
            columns = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=PARTS.names
            )

    bound_batches(pages.sparkSession)
    parts = urls.select(url_key(F.col("url")), "url").mapInArrow(run, PARTS)
    summed = (
        parts.join(values.filter(~often).select("gram", "value"), "gram", "left")
        .groupBy("key")
        .agg(F.sum(F.coalesce("held", F.col("times") * F.col("value"))).alias("sum"))
    )
    lengths = urls.select(url_key(F.col("url")).alias("key"), F.char_length("url").alias("chars"))
    return written(summed.join(lengths, "key").select("key", (F.col("sum") / F.lit(float(UNIT)) / F.col("chars")).alias("score")), "url-scores")


def with_scores(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """Add ``score``, 0 for an empty URL."""
    keyed = rows.withColumn("key", url_key(F.col("url")))
    return keyed.join(scores, "key", "left").withColumn("score", F.coalesce("score", F.lit(0.0))).drop("key")


def train(decided: DataFrame) -> dict[str, dict[str, tuple[int, int, dict[str, int]]]]:
    """The models of a small table as plain values, to check scores by: context -> (characters, different ones, counts)."""
    models: dict = {kind: {} for kind in ("allow", "block")}
    for r in grams(decided).collect():
        n, types, following = models[r["kind"]].get(r["gram"][:-1], (0, 0, {}))
        models[r["kind"]][r["gram"][:-1]] = (n + r["n"], types + 1, following | {r["gram"][-1]: r["n"]})
    return models


def log_likelihood(text: str, model: dict[str, tuple[int, int, dict[str, int]]]) -> float:
    total = 0.0
    for k in range(ORDER, len(text)):
        p = 1 / ALPHABET
        for o in range(ORDER + 1):
            held = model.get(text[k - o : k])
            if held is None:
                break
            n, types, following = held
            p = (following.get(text[k], 0) + types * p) / (n + types)
        total += log(p)
    return total


def score(url: str | None, models: dict) -> float:
    """Log likelihood as an accepted URL less that as a rejected one, per character; 0 for an empty URL."""
    if not url:
        return 0.0
    text = symbols(url)
    return (log_likelihood(text, models["allow"]) - log_likelihood(text, models["block"])) / len(url)


def calibrate(known: DataFrame) -> float:
    """The threshold with the best mean of both classes' accuracy on scored, decided URLs; 0 without both classes."""
    width = 2 * SPAN / BINS
    place = F.least(F.greatest(F.floor((F.col("score") + SPAN) / width), F.lit(0)), F.lit(BINS - 1))
    bins = known.groupBy("kind", place.cast("int").alias("bin")).count().collect()  # at most 2 * BINS rows
    count = Counter({(r["kind"], r["bin"]): r["count"] for r in bins})
    of = {kind: sum(n for (k, _), n in count.items() if k == kind) for kind in ("allow", "block")}
    if not of["allow"] or not of["block"]:
        return 0.0
    best, at, caught, passed = -1.0, [], 0, of["allow"]
    for b in range(BINS + 1):  # block what lies below bin b
        rate = caught / of["block"] + passed / of["allow"]
        if rate > best + 1e-12:
            best, at = rate, [b]
        elif rate > best - 1e-12:
            at.append(b)
        caught += count["block", b]
        passed -= count["allow", b]
    return at[len(at) // 2] * width - SPAN


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every row.

    A NULL URL has an empty host and path, a score of 0 and so the verdict that 0
    gets; repeated rows are judged alike; other columns are ignored.
    """
    rows = ruled(pages.select("page_id", "url"), rules)
    decided = rows.filter("kind IS NOT NULL").withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)))
    scores = scored(rows, decided.filter("fold > 0"))
    threshold = calibrate(with_scores(decided.filter("fold = 0"), scores))
    verdict = F.coalesce("kind", F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block")))
    return with_scores(rows, scores).select(
        F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", verdict.alias("verdict"), "score"
    )
