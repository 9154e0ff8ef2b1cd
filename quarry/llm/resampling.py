"""Quality by importance resampling (Xie et al. 2023, DSIR).

Two generative models of hashed word 1- and 2-grams are estimated: one of
target text (labelled good and not toxic) and one of all text. The log ratio
of a document's probabilities under both is its importance weight. Gumbel
noise from the document's identity is added and the k largest keys are the
sample, which is a draw without replacement in proportion to the weights.
Thresholds on the weight and on the ratio of the document's least likely word
(a few toxic words weigh little in a long text), set on labelled rows that the
target model has not seen, turn it into a classifier.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .spread import stage

BUCKETS = 1 << 19  # the first half for single words, the second for pairs
# Labelled rows used: those with the smallest id hashes, at most so many.
LEARN_ROWS = 50_000
SAMPLE = 0.25  # share of all rows that the sample holds
SMOOTHING = 10.0  # keeps the ratios of rare grams near 0


def _grams(b: tokens.Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every occurrence of a 1- or 2-gram."""
    words, own = tokens.word_hashes(b), tokens.owners(b.bounds)
    pairs, at = tokens.windows(words, b.bounds, 2)
    h = np.concatenate((tokens.mix(words), pairs)) >> np.uint64(64 - BUCKETS.bit_length() + 2)
    h[len(words):] += np.uint64(BUCKETS // 2)
    return h.astype(np.int64), np.concatenate((own, own[at]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = np.asarray(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), bool)
        for b in tokens.blocks(batch.column(0)):
            grams, own = _grams(b)
            total += np.bincount(grams, minlength=BUCKETS)
            target += np.bincount(grams[good[b.first + own]], minlength=BUCKETS)
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot]), pa.array(target[slot])], ["slot", "total", "target"])


def labelled(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(_key, good, tuning) of the sample of labelled rows: good is quality 1
    and not toxic, tuning a third of the rows that sets the threshold. Rows
    with a null key or quality are left out; a null toxic counts as 0; of
    several labels of a key the worst counts."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    rows = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(good.cast("int")).alias("good"))
    rows = rows.withColumn("_order", F.xxhash64("_key")).orderBy("_order", "_key").limit(LEARN_ROWS)
    return rows.select("_key", (F.col("good") == 1).alias("good"), (F.pmod("_order", F.lit(3)) == 0).alias("tuning"))


def weights(marked: DataFrame) -> np.ndarray:
    """Log ratio of the target's and all text's probability of each bucket,
    from rows of (text, target). Without target text all ratios are 0."""
    counts = marked.mapInArrow(_counted, "slot long, total long, target long").groupBy("slot").agg(
        F.sum("total").alias("total"), F.sum("target").alias("target")).toPandas()
    total, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    total[counts["slot"]], target[counts["slot"]] = counts["total"], counts["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    p = lambda x: np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * BUCKETS))
    share = target.sum() / total.sum()  # smooth both by the same number of words
    return p(target / share) - p(total)


def _scorer(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = table.value
        for batch in batches:
            for b in tokens.blocks(batch.column(1)):
                n = len(b.bounds) - 1
                grams, own = _grams(b)
                lowest = np.zeros(n)
                one = grams < BUCKETS // 2
                np.minimum.at(lowest, own[one], w[grams[one]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.first, n), pa.array(np.bincount(own, minlength=n).astype(np.int64)),
                     pa.array(np.bincount(own, w[grams], n).astype(float)), pa.array(lowest)], ["_row", "n_grams", "log_ratio", "lowest"])

    return run


def kth_largest(frame: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column without nulls or NaN, by counting in
    ever narrower ranges of 1000 bins; None when there are fewer than k rows."""
    low, high, n = frame.agg(F.min(column), F.max(column), F.count(column)).first()
    if not 0 < k <= n:
        return None
    above, inside = 0, n
    while inside > 10_000 and low < high:
        width = (high - low) / 1000
        if low + width == low:
            break
        value = F.col(column)
        bin_ = F.least(F.floor((value - low) / width), F.lit(999))
        bins = {r[0]: r[1:] for r in frame.where(value.between(low, high)).groupBy(bin_.alias("bin")).agg(
            F.count(F.lit(1)), F.min(value), F.max(value)).collect()}
        for b in sorted(bins, reverse=True):
            count, least, most = bins[b]
            if above + count >= k:
                low, high, inside = least, most, count
                break
            above += count
        if len(bins) == 1 and low == high:
            break
    if low == high:
        return low
    return frame.where(F.col(column).between(low, high)).orderBy(F.desc(column)).limit(k - above).agg(F.min(column)).first()[0]


def best_threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """Cut with the fewest wrong verdicts, the lowest of several; without both
    classes, one that keeps everything."""
    if not len(good) or good.all() or not good.any():
        return -math.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    cut = np.flatnonzero(np.append(s[:-1] < s[1:], False))
    if not len(cut):
        return -math.inf
    right = np.cumsum(~g)[cut] - np.cumsum(g)[cut]
    if right.max() <= 0:
        return -math.inf
    i = cut[int(right.argmax())]
    return float((s[i] + s[i + 1]) / 2)


def resample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", share: float = SAMPLE, seed: int = 1) -> DataFrame:
    """key, n_grams, log_ratio, lowest, gumbel_key, kept and selected for every row.

    ``kept`` is the classifier's verdict, ``selected`` marks the
    ceil(share * rows) largest Gumbel keys; rows with the key of the last one,
    which only repeated rows have, are selected too. Null or empty texts have
    no grams, a log ratio of 0, and are not kept; they may be sampled. Without
    labels all log ratios are 0, everything else is kept and the sample is
    uniform. An empty table gives an empty result.
    """
    known = F.broadcast(stage(labelled(labels, key), "labelled"))
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(known, "_key", "left")
    w = weights(rows.select("_text", (F.col("good") & ~F.col("tuning")).alias("target")))
    noise = (F.shiftrightunsigned(F.xxhash64("_key", "_text", F.lit(seed)), 12).cast("double") + 0.5) / 2.0**52
    row = F.struct("_key", "good", "tuning", (-F.log(-F.log(noise))).alias("gumbel"))
    kind = "struct<" + f"_key:{docs.schema[key].dataType.simpleString()},good:boolean,tuning:boolean,gumbel:double>"
    scored = rows.select(row.alias("_row"), "_text").mapInArrow(
        _scorer(docs.sparkSession.sparkContext.broadcast(w)), f"_row {kind}, n_grams long, log_ratio double, lowest double")
    scored = stage(scored.select("_row.*", "n_grams", "log_ratio", "lowest", (F.col("log_ratio") + F.col("_row.gumbel")).alias("gumbel_key")), "scored")
    tuned = scored.where("tuning and n_grams > 0").select("_key", "log_ratio", "lowest", "good").orderBy("_key", "log_ratio").limit(LEARN_ROWS).toPandas()
    least = best_threshold(tuned["lowest"].to_numpy(float), tuned["good"].to_numpy(bool))
    tuned = tuned[tuned["lowest"] > least]
    threshold = best_threshold(tuned["log_ratio"].to_numpy(float), tuned["good"].to_numpy(bool))
    last = kth_largest(scored, "gumbel_key", math.ceil(share * scored.count()))
    return scored.select(
        F.col("_key").alias(key), "n_grams", "log_ratio", "lowest", "gumbel_key",
        ((F.col("n_grams") > 0) & (F.col("log_ratio") > threshold) & (F.col("lowest") > least)).alias("kept"),
        (F.lit(False) if last is None else F.col("gumbel_key") >= last).alias("selected"))
