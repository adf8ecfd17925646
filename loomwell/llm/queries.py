"""The registered queries of these operators, one for each, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.llm import (
    fim,
    lang_id,
    license_scan,
    line_dedup,
    minhash,
    mixing,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    spelling,
    url_filter,
)
from loomwell.llm.common import written
from loomwell.llm.packing import tokenizer_files
from loomwell.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def values(rows, *columns: str) -> str:
    quoted = [", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) for row in rows]
    return f"(VALUES {', '.join(f'({q})' for q in quoted)}) AS v({', '.join(columns)})"


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprinted(load(spark, sf_dir, "documents"))


@query("simhash_near_pairs")
def simhash_near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the radius search finds, by fingerprint; op2 names the documents of a fingerprint."""
    return simhash.near_pairs(load(spark, sf_dir, "documents"))


# words, three-word windows that occur twice, and lines, as DuckDB lists
QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1)
  GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id
), f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed::BIGINT AS failed
FROM f
"""


@query("op8_quality_rules", QUALITY_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(load(spark, sf_dir, "documents"))


ABLATION_SQL = f"""
SELECT {quality.CURRENT} AS policy, rule, count(*) FILTER (WHERE failed & bit <> 0) AS fails,
       count(*) FILTER (WHERE failed & {quality.mask(quality.POLICIES[quality.CURRENT])} = bit) AS "only",
       count(*) FILTER (WHERE failed & {quality.mask(quality.POLICIES[quality.CURRENT])} IN (0, bit)) AS kept_without,
       bool_or(failed & bit <> 0) AS ever_failed
FROM ({QUALITY_SQL}), {values([(n, quality.mask((n,))) for n in quality.POLICIES[quality.CURRENT]], "rule", "bit")} GROUP BY rule
"""


@query("quality_ablations", ABLATION_SQL)
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy does, from the stored ledger's bits alone."""
    return quality.ablations(written(quality.rule_ledger(load(spark, sf_dir, "documents")), "quality-ledger"))


@query("op1_url_filter")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(load(spark, sf_dir, "pages"))


@query("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.reported(load(spark, sf_dir, "documents"))


@query("op4_line_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without later copies of line runs, and how many lines that took."""
    done = line_dedup.without_repeats(load(spark, sf_dir, "documents"))
    return done.select("_row.doc_id", "_cut.lines", "_cut.deleted", F.col("_text").alias("text"))


# target weights; every other source, documents without one included, has 1
MIX = {"src0": 6.0, "src1": 2.5, "src2": 0.5, "src3": 1.75}


@query("op5_source_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed order of all documents, each source's target share, and how far it is from it after each block."""
    placed = written(mixing.mixed(load(spark, sf_dir, "documents"), MIX), "mixed")
    return mixing.with_lag(placed, MIX)


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(load(spark, sf_dir, "documents"))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), *tokenizer_files())


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.predicted(load(spark, sf_dir, "documents"))


@query("op10_near_duplicates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of documents with 80 % of their four-word shingles in common."""
    return minhash.near_duplicates(load(spark, sf_dir, "documents"), size=4, percent=80)


# Words with their places; phrases by their words in a row; templates by counting their words in each block.
LICENSE_SQL = rf"""
WITH phrases AS (SELECT label, string_split(phrase, ' ') AS p FROM {values(license_scan.PHRASES, 'label', 'phrase')}
), templates AS (
  SELECT id, label, list_distinct(string_split(body, ' ')) AS t
  FROM {values([(k, *t) for k, t in enumerate(license_scan.TEMPLATES)], 'id', 'label', 'body')}
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), w AS (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM d
), places AS (
  SELECT w.r, f.label, w.i FROM w JOIN phrases f ON w.x = f.p[1] JOIN d ON d.r = w.r
  WHERE d.w[w.i + 1:w.i + len(f.p)] = f.p
), base AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY r
), parts AS (SELECT id, label, len(t) AS size, unnest(t) AS x FROM templates
), hits AS (
  SELECT r, block, id, label, size, count(DISTINCT x) AS shared FROM (
    SELECT r, x, unnest([i // {license_scan.STEP}, i // {license_scan.STEP} - 1]) AS block FROM w) JOIN parts USING (x)
  WHERE block >= 0 GROUP BY ALL HAVING 100 * shared >= {license_scan.PERCENT} * size
), larger AS (
  SELECT a.id AS small, b.id AS large FROM templates a JOIN templates b
  ON a.label <> b.label AND len(a.t) < len(b.t) AND list_has_all(b.t, a.t)
), kept AS (
  SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits o JOIN larger ON small = h.id AND large = o.id WHERE o.r = h.r AND o.block = h.block)
), more AS (SELECT r, list(DISTINCT label) AS labels, max(shared / size) AS share FROM kept GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM d LEFT JOIN base b ON b.r = d.r LEFT JOIN more m ON m.r = d.r
"""


@query("op11_license_scan", LICENSE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(load(spark, sf_dir, "documents"))


# Lines by splitting at line feeds; a cut after k of them is the length of the first k.
FIM_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, l, (len(l) - (l[len(l)] = '')::INT)::BIGINT AS n,
         [('0x' || substr(h, 8 * k + 1, 8))::BIGINT FOR k IN range(4)] AS h FROM d
), c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 AS plain FROM u
), p AS (
  SELECT doc_id, t, n, plain, h, CASE WHEN a = n THEN length(t) ELSE coalesce(list_sum([length(x) + 1 FOR x IN l[1:a]]), 0) END::BIGINT AS x,
         CASE WHEN b = n THEN length(t) ELSE coalesce(list_sum([length(x) + 1 FOR x IN l[1:b]]), 0) END::BIGINT AS y FROM c
), f AS (SELECT *, CASE WHEN plain THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM p)
SELECT doc_id, n, form, CASE WHEN NOT plain THEN x END AS prefix_chars, CASE WHEN NOT plain THEN y - x END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
         WHEN 'psm' THEN '<P>' || substr(t, 1, x) || '<S>' || substr(t, y + 1) || '<M>' || substr(t, x + 1, y - x)
         ELSE '<S>' || substr(t, y + 1) || '<P>' || substr(t, 1, x) || '<M>' || substr(t, x + 1, y - x) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""


@query("op12_fill_in_middle", FIM_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.rewritten(load(spark, sf_dir, "documents"))


# The checksum by its defining table; near words by leaving out or masking each letter in turn.
SPELLING_SQL = """
WITH RECURSIVE t8 AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), runs AS (
  SELECT id, run, count(*) AS k FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) WHERE length(run) >= 6 GROUP BY ALL
), summed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295, [('0x' || substr(x, 2 * i + 1, 2))::BIGINT FOR i IN range(length(x) // 2)]),
                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, k, hex(encode(id || ':' || run)) AS x FROM runs), t8
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, k FROM summed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), cut AS (
  SELECT word, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT x.word AS u, y.word AS v FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b WHERE x.word <> y.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.a || c.b
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.a || c.b
), best AS (
  SELECT u, count(*) AS n_near, first(v ORDER BY m.n DESC, v) AS v, max(m.n) AS m FROM near JOIN words m ON m.word = v GROUP BY u
), judged AS (
  SELECT word, CASE WHEN m >= 5 * n THEN v END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN best ON u = word
), chain AS (
  SELECT word, word AS root, 0 AS steps FROM judged
  UNION ALL SELECT c.word, j.form, steps + 1 FROM chain c JOIN judged j ON j.word = c.root WHERE j.form IS NOT NULL
), ends AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)
"""


@query("op13_spelling_variants", SPELLING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(load(spark, sf_dir, "documents"))
