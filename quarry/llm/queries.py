"""Registered queries of the training-data operators and their SQL checks.

Each query reads a whole table, applies one operator with its production
parameters and derives the stated result columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, curriculum, decision_list, decontamination, extraction, language, licenses, ngrams, phrases, pieces, resampling, setsketch, warc

QUERIES = {}
ORACLES = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Lower-cases A-Z only.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c USING (doc_id)
"""


@_query("op1_near_duplicates", OP1_SQL)
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the learned decision list's verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    rules = decision_list.learn(docs, table(spark, sf_dir, "labels"))
    judged = decision_list.judge(docs, rules, carry=["doc_id"])
    return judged.select("_row.doc_id", *decision_list.COUNTS, "base_failed", "kept", "rule")


_NORMAL_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, {_NORMAL_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_NORMAL_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark
), iw AS (
  SELECT item, least(len(w), 13) AS size, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i, w FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS x FROM iw
), dw AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size
), hit AS (
  SELECT DISTINCT dw.doc_id, dw.i, dw.size, win.item FROM dw JOIN win ON win.size = dw.size AND win.x = array_to_string(dw.w[dw.i:dw.i + dw.size - 1], ' ')
), n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id
), k AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@_query("op8_decontamination", OP8_SQL)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("_row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    """Path of an installed public tokenizer file; QUARRY_PIECES overrides it."""
    import public_tokenizers

    return os.environ.get("QUARRY_PIECES") or public_tokenizers.path(name)


@_query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and whether they decode to its text."""
    coded = pieces.encode(table(spark, sf_dir, "documents"), vocabulary(), carry=["doc_id"])
    return coded.select("_row.doc_id", "n_tokens", "ids", "round_trip")


def _bucket(divisor: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


@_query("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those outside the held-out part."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(_bucket(4) == 2, F.lit(False)))
    model = language.learn(docs.where(~F.col("held_out")))
    found = language.identify(docs, model, carry=["doc_id", "held_out"])
    return found.select("_row.*", F.col("lang").alias("lang_pred"), "score", F.size("spans").alias("n_spans"))


@_query("op7_extraction")
def op7_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extraction.extract(table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return found.select("_row.*", "text", F.char_length("text").cast("long").alias("n_chars"))


OP10_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS holder FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < holder THEN holder END AS refers_to
FROM k
"""


@_query("op10_warc", OP10_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from the archives written for it."""
    folder = warc.archive_folder(spark)
    index = warc.write(table(spark, sf_dir, "pages"), folder)
    found = warc.read(index, folder)
    damaged = F.when(~F.col("intact"), F.raise_error(F.concat(F.lit("damaged record: "), "page_key")))
    return found.select(F.expr("try_cast(page_key as bigint)").alias("page_id"), "payload_bytes", "payload_digest",
                        F.coalesce(damaged.cast("string"), "record_type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


@_query("op9_resampling")
def op9_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, verdict and sample of every document."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op3_ngram_scores")
def op3_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie and unigram log-probabilities of every document."""
    return ngrams.score(table(spark, sf_dir, "documents"), _bucket(7) != 2, order=3)


_LICENSES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.TEMPLATES.items())
_PLAIN = "regexp_extract_all(lower(coalesce({}, '')), '[a-z0-9]+')"
_FIVES = "list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"

OP5_SQL = f"""
WITH t AS (
  SELECT license, unnest({_FIVES}) AS x FROM (SELECT license, {_PLAIN.format("body")} AS w FROM (VALUES {_LICENSES}) v(license, body))
), d AS (
  SELECT doc_id, unnest({_FIVES}) AS x FROM (SELECT doc_id, {_PLAIN.format("text")} AS w FROM documents)
), n AS (
  SELECT license, count(*) AS n FROM t GROUP BY license
)
SELECT doc_id, license, n AS n_shingles, count(*) AS n_found, count(*) / n AS containment
FROM d JOIN t USING (x) JOIN n USING (license)
GROUP BY doc_id, license, n HAVING 100 * count(*) >= 75 * n
"""


@_query("op5_licenses", OP5_SQL)
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH t AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents
), p AS (
  SELECT lang, regexp_extract_all(unnest(pieces), '[^\\x20\\x09]+') AS w FROM t
), occ AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k)
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS n FROM occ GROUP BY lang, k, phrase
), total AS (
  SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS MATERIALIZED (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10
), cut AS (
  SELECT c.lang, c.k, c.phrase, c.a, j, x.n AS l, y.n AS r,
    (1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
  FROM (SELECT *, array_to_string(w[1:j], ' ') AS p1, array_to_string(w[j + 1:], ' ') AS p2 FROM (SELECT *, unnest(range(1, k)) AS j FROM c)) c
  JOIN f x ON x.lang = c.lang AND x.phrase = p1
  JOIN f y ON y.lang = c.lang AND y.phrase = p2
), weakest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), covered AS (
  SELECT lang, phrase, max(over) AS over FROM (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS over FROM c WHERE k = 3)
  GROUP BY lang, phrase
), kept AS (
  SELECT s.* FROM weakest s LEFT JOIN covered v ON v.lang = s.lang AND v.phrase = s.phrase
  WHERE s.k = 3 OR v.over IS NULL OR 100 * v.over < 50 * s.a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(total.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000
"""


@_query("op13_phrases", OP13_SQL)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two and three words of every language."""
    return phrases.mine(table(spark, sf_dir, "documents"))


@_query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between a byte-level and a piece tokenizer in every document."""
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = alignment.link(table(spark, sf_dir, "documents"), *files, carry=["doc_id"])
    return found.select("_row.doc_id", *(c for c in found.columns if c != "_row"))


# Weight schedules of integral 3, 1 and 2 whose sum is level: the first fades,
# the second grows, the third stays.
SCHEDULES = [[(0, 4), (1, 2)], [(0, 0), (1, 2)], [(0, 2), (1, 2)]]

OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM d GROUP BY source
), f AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS i FROM s
), fill AS (
  SELECT 0::BIGINT AS i, 1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM s) AS words_left, (SELECT sum(weight) FROM s) AS weight_left
  UNION ALL
  SELECT f.i, fill.words_left - f.most, fill.weight_left - f.weight FROM fill JOIN f ON f.i = fill.i + 1
  WHERE f.most <= fill.words_left / fill.weight_left * f.weight
), level AS (
  SELECT CASE WHEN weight_left > 0 THEN words_left / weight_left END AS level FROM fill ORDER BY i DESC LIMIT 1
), t AS (
  SELECT source, source_size, coalesce(least(most, level * weight), most) AS target FROM f, level
), o AS (
  SELECT d.row, d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS take,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, take - start)) + greatest(0, least(size, take - source_size - start)) AS BIGINT) AS taken FROM o
"""


@_query("op11_mixing", OP11_SQL)
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes, from the training order."""
    ordered = curriculum.plan(table(spark, sf_dir, "documents"), SCHEDULES)
    one = [F.first(c).alias(c) for c in ("_key", "size", "source_size", "target")]
    taken = ordered.groupBy("_row").agg(*one, F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"))
    return taken.select(F.col("_key").alias("doc_id"), "size", "source_size", "target", "taken")
