"""License notices in texts, by DataFrame and SQL functions only.

Texts are cut into overlapping windows of ``WINDOW`` words. Each window has
``BANDS`` MinHash bands of one row over its 5-word shingles; windows whose
bands occur among those of the templates retrieve these templates. A shingle
lies in two windows of at most four shingles, the first of a text in one that
begins before it, so a notice of a single shingle is retrieved with a
probability of at least 1 - 0.75 ** (2 * BANDS), which is 0.999; every further
shingle adds to it. Retrieved pairs are verified by exact containment: at least ``CONTAINED`` per cent of the
template's distinct shingles must occur in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import TEMPLATES
from .spread import stage

WORDS = 5
WINDOW = 8
STEP = 2
BANDS = 12
CONTAINED = 75


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits of the text in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), 0)


def _windows(source: DataFrame, keys: list[str], step: int) -> DataFrame:
    """The keys and the bands h0.. of every window that holds a shingle; the
    first and the last windows of a text hold fewer and repeat one."""
    held = WINDOW - WORDS + 1
    hashed = source.where(F.size("_words") >= WORDS).select(*keys, F.transform(
        F.sequence(F.lit(1), F.size("_words") - (WORDS - 1)), lambda i: F.xxhash64(F.slice("_words", i, WORDS))).alias("_s"))
    begins = F.sequence(F.lit(-step if step > 1 else 0), F.size("_s") - 1, F.lit(step))
    window = hashed.select(*keys, F.inline(F.transform(begins, lambda i: F.struct(
        *[F.get("_s", F.greatest(F.lit(0), F.least(i + j, F.size("_s") - 1))).alias(f"s{j}") for j in range(held)]))))
    low = [F.least(*[F.xxhash64(f"s{j}", F.lit(i)) for j in range(held)]).alias(f"h{i}") for i in range(BANDS)]
    return window.select(*keys, *low)


def _shingles(source: Column) -> Column:
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(source) - (WORDS - 1)), lambda i: F.array_join(F.slice(source, i, WORDS), " ")))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """One row per text and template it contains: key, license, n_shingles
    (distinct shingles of the template), n_found (those in the text) and
    containment.

    Null, empty and short texts contain nothing; templates of fewer than five
    words cannot match. Repeated rows give one result; a key with different
    texts gives the results of each. Null keys are kept apart from others.
    """
    spark: SparkSession = docs.sparkSession
    known = spark.createDataFrame(list((TEMPLATES if templates is None else templates).items()), "license string, _body string")
    known = known.select("license", words(F.col("_body")).alias("_words")).where(F.size("_words") >= WORDS)
    bands = F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.col(f"h{i}").alias("h")) for i in range(BANDS)]))
    index = _windows(known, ["license"], 1).select("license", bands.alias("b")).select("license", "b.band", "b.h").distinct()
    values: dict[int, list[int]] = {}
    for row in index.collect():  # bounded by the templates, not by the texts
        values.setdefault(row.band, []).append(row.h)

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_digest"))
    cut = rows.select("_key", "_digest", words(F.col("_text")).alias("_words"))
    met = None
    for i, own in values.items():
        one = F.col(f"h{i}").isin(own)
        met = one if met is None else met | one
    hits = _windows(cut, ["_key", "_digest"], STEP).where(F.lit(False) if met is None else met)
    hits = hits.select("_key", "_digest", bands.alias("b")).select("_key", "_digest", "b.band", "b.h")
    pairs = stage(hits.join(F.broadcast(index), ["band", "h"]).select("_key", "_digest", "license").distinct(), "pairs")

    full = known.select("license", _shingles(F.col("_words")).alias("_template"))
    asked = pairs.groupBy("_key", "_digest").agg(F.collect_set("license").alias("_licenses"))  # at most one of each template
    same = asked["_key"].eqNullSafe(rows["_key"]) & (asked["_digest"] == rows["_digest"])
    texts = rows.join(asked, same).select(rows["_key"], rows["_digest"], words(F.col("_text")).alias("_words"), "_licenses")
    texts = texts.select("_key", "_digest", _shingles(F.col("_words")).alias("_own"), F.explode("_licenses").alias("license"))
    found = texts.join(F.broadcast(full), "license").select(
        "_key", "_digest", "license", F.size("_template").cast("long").alias("n_shingles"),
        F.size(F.array_intersect("_template", "_own")).cast("long").alias("n_found"))
    found = found.where(100 * F.col("n_found") >= CONTAINED * F.col("n_shingles")).distinct()
    return found.select(F.col("_key").alias(key), "license", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))
