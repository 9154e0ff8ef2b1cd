"""Evaluation of ranked runs against graded judgments (trec_eval semantics).

Inputs
  run:    (run_id, qid, doc, rank, score)    rank is 1-based, total order
  qrels:  (qid, doc, rel) or, for judgments shared by every need, (doc, rel)
  needs:  (qid) every information need, so a need without results still
          gets P@k = 0

Definitions (relevant = rel >= threshold; unjudged counts as grade 0):
  P@k       hits in the top k / k (always k)
  AP        sum over relevant ranks of (hits so far / rank) / R
  Recall@k  hits in the top k / R
  RR@k      1 / first relevant rank <= k, else 0
  nDCG@k    sum gain/log2(rank+1) over the top k / same for the ideal
            order of all judged grades; gain = rel (linear) or 2^rel - 1
  iprec(L)  max precision at ranks whose hits >= floor(L * R + 0.5)
AP, Recall and RR are null when R = 0; nDCG is null when no judged grade is
positive. Means skip nulls.

All per-query work is a window over one (run, qid) ranking, which holds at
most the run depth (20) rows, so partitions stay small at any scale.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = [i / 10 for i in range(11)]


def grades_from_labels(labels: DataFrame) -> DataFrame:
    """Driver mapping of judgments: 2 = good and clean, 1 = good but toxic,
    0 = otherwise. (doc, rel)."""
    rel = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(2))
        .when((F.col("quality") == 1) & (F.col("toxic") == 1), F.lit(1))
        .otherwise(F.lit(0))
    )
    return labels.select(F.col("doc_id").alias("doc"), rel.alias("rel"))


def _shared(qrels: DataFrame) -> bool:
    return "qid" not in qrels.columns


def judged_stats(qrels: DataFrame, threshold: int = 1, depth: int = 10) -> DataFrame:
    """Per need (or one row for shared judgments): judged, R, positive,
    ideal DCG@depth (linear and exponential)."""
    key = [] if _shared(qrels) else ["qid"]
    counts = qrels.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_judged"),
        F.count_if(F.col("rel") >= threshold).alias("n_relevant"),
        F.count_if(F.col("rel") > 0).alias("n_positive"),
    )
    pos_rel = qrels.filter(F.col("rel") > 0)
    if key:
        w = Window.partitionBy(*key).orderBy(F.col("rel").desc(), F.col("doc").asc())
        ideal = pos_rel.withColumn("_p", F.row_number().over(w)).filter(F.col("_p") <= F.lit(depth))
    else:
        top = pos_rel.orderBy(F.col("rel").desc(), F.col("doc").asc()).limit(depth)
        ideal = top.withColumn("_p", F.row_number().over(Window.orderBy(F.col("rel").desc(), F.col("doc").asc())))
    disc = F.log2(F.col("_p") + F.lit(1))
    idcg = ideal.groupBy(*key).agg(
        F.sum(F.col("rel") / disc).alias("idcg"),
        F.sum((F.pow(F.lit(2.0), F.col("rel")) - 1) / disc).alias("idcg_exp"),
    )
    if key:
        return counts.join(idcg, key, "left")
    return _one_row_join(counts, idcg)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two one-row aggregates (b may be empty)."""
    a1 = a.withColumn("_k", F.lit(1))
    b1 = b.withColumn("_k", F.lit(1))
    return a1.join(F.broadcast(b1), "_k", "left").drop("_k")


def graded_run(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """run ⟕ qrels: rel is null for unjudged documents."""
    if _shared(qrels):
        return run.join(qrels.select("doc", "rel"), "doc", "left")
    return run.join(qrels.select("qid", "doc", "rel"), ["qid", "doc"], "left")


def _attach_stats(df: DataFrame, stats: DataFrame, shared: bool) -> DataFrame:
    if shared:
        s1 = stats.withColumn("_k", F.lit(1))
        return df.withColumn("_k", F.lit(1)).join(F.broadcast(s1), "_k").drop("_k")
    return df.join(stats, "qid", "left")


def per_query(run: DataFrame, qrels: DataFrame, needs: DataFrame, run_ids: Sequence[str],
              threshold: int = 1, digits: int = 4) -> DataFrame:
    """(run_id, qid, retrieved, rel_retrieved, unjudged, p5, p10, ap, ndcg10,
    recall20, rr10, ndcg10_exp) for every need of every run id."""
    shared = _shared(qrels)
    g = graded_run(run, qrels)
    is_rel = F.coalesce(F.col("rel"), F.lit(0)) >= threshold
    w = Window.partitionBy("run_id", "qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("_rel", is_rel.cast("int")).withColumn("_hits", F.sum("_rel").over(w))
    gain = F.coalesce(F.col("rel"), F.lit(0)).cast("double")
    disc = F.log2(F.col("rank") + F.lit(1))
    agg = g.groupBy("run_id", "qid").agg(
        F.count(F.lit(1)).alias("retrieved"),
        F.sum("_rel").alias("rel_retrieved"),
        F.count_if(F.col("rel").isNull()).alias("unjudged"),
        F.count_if(is_rel & (F.col("rank") <= 5)).alias("_h5"),
        F.count_if(is_rel & (F.col("rank") <= 10)).alias("_h10"),
        F.count_if(is_rel & (F.col("rank") <= 20)).alias("_h20"),
        F.sum(F.when(is_rel, F.col("_hits") / F.col("rank"))).alias("_apsum"),
        F.max(F.when(is_rel & (F.col("rank") <= 10), F.lit(1.0) / F.col("rank"))).alias("_rr"),
        F.sum(F.when(F.col("rank") <= 10, gain / disc)).alias("_dcg"),
        F.sum(F.when(F.col("rank") <= 10, (F.pow(F.lit(2.0), gain) - 1) / disc)).alias("_dcg_exp"),
    )
    frames = [needs.select("qid").withColumn("run_id", F.lit(r)) for r in run_ids]
    base = frames[0]
    for f in frames[1:]:
        base = base.unionByName(f)
    full = base.join(agg, ["run_id", "qid"], "left")
    full = _attach_stats(full, judged_stats(qrels, threshold), shared)
    R = F.col("n_relevant")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    has_r = R > 0
    has_pos = F.coalesce(F.col("n_positive"), F.lit(0)) > 0
    return full.select(
        "run_id", "qid",
        z("retrieved").cast("long").alias("retrieved"),
        z("rel_retrieved").cast("long").alias("rel_retrieved"),
        z("unjudged").cast("long").alias("unjudged"),
        F.round(z("_h5") / 5.0, digits).alias("p5"),
        F.round(z("_h10") / 10.0, digits).alias("p10"),
        F.round(F.when(has_r, F.coalesce(F.col("_apsum"), F.lit(0.0)) / R), digits).alias("ap"),
        F.round(F.when(has_pos, F.coalesce(F.col("_dcg"), F.lit(0.0)) / F.col("idcg")), digits).alias("ndcg10"),
        F.round(F.when(has_r, z("_h20") / R), digits).alias("recall20"),
        F.round(F.when(has_r, F.coalesce(F.col("_rr"), F.lit(0.0))), digits).alias("rr10"),
        F.round(F.when(has_pos, F.coalesce(F.col("_dcg_exp"), F.lit(0.0)) / F.col("idcg_exp")), digits).alias("ndcg10_exp"),
    )


METRICS = ("p5", "p10", "ap", "ndcg10", "recall20", "rr10")


def mean_and_delta(pq: DataFrame, a: str, b: str, digits: int = 4) -> DataFrame:
    """(metric, mean_a, mean_b, delta): macro means (nulls skipped) of two
    runs and b - a (null if either is null)."""
    means = pq.groupBy("run_id").agg(*[F.avg(m).alias(m) for m in METRICS])
    long = means.selectExpr(
        "run_id", "stack({n}, {p}) AS (metric, value)".format(
            n=len(METRICS), p=", ".join(f"'{m}', {m}" for m in METRICS)
        )
    )
    wide = long.groupBy("metric").agg(
        F.max(F.when(F.col("run_id") == a, F.col("value"))).alias("mean_a"),
        F.max(F.when(F.col("run_id") == b, F.col("value"))).alias("mean_b"),
    )
    return wide.select(
        "metric", F.round("mean_a", digits).alias("mean_a"), F.round("mean_b", digits).alias("mean_b"),
        F.round(F.col("mean_b") - F.col("mean_a"), digits).alias("delta"),
    )


def pr_curve(run: DataFrame, qrels: DataFrame, threshold: int = 1, digits: int = 4) -> DataFrame:
    """EV10: (run_id, qid, recall, precision) 11-point interpolated precision
    for needs with R > 0. trec_eval's recall cut is floor(L*R + 0.5)."""
    shared = _shared(qrels)
    g = graded_run(run, qrels)
    is_rel = (F.coalesce(F.col("rel"), F.lit(0)) >= threshold).cast("int")
    w = Window.partitionBy("run_id", "qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("_hits", F.sum(is_rel).over(w)).withColumn("_prec", F.col("_hits") / F.col("rank"))
    g = _attach_stats(g, judged_stats(qrels, threshold), shared).filter(F.col("n_relevant") > 0)
    lv = g.select("run_id", "qid", "_hits", "_prec", "n_relevant",
                  F.explode(F.array(*[F.lit(x) for x in LEVELS])).alias("recall"))
    cut = F.floor(F.col("recall") * F.col("n_relevant") + F.lit(0.5))
    out = lv.groupBy("run_id", "qid", "recall").agg(
        F.max(F.when(F.col("_hits") >= cut, F.col("_prec"))).alias("_p")
    )
    return out.select("run_id", "qid", "recall", F.round(F.coalesce("_p", F.lit(0.0)), digits).alias("precision"))


def pool(run_a: DataFrame, run_b: DataFrame, depth: int = 20) -> DataFrame:
    """EV1 + JN9 + UN1: union of two top-``depth`` lists per need with each
    side's rank and score; ``pool_order`` sorts by best rank then doc."""
    a = run_a.filter(F.col("rank") <= depth).select("qid", "doc", F.col("rank").alias("rank_a"), F.col("score").alias("score_a"))
    b = run_b.filter(F.col("rank") <= depth).select("qid", "doc", F.col("rank").alias("rank_b"), F.col("score").alias("score_b"))
    p = a.join(b, ["qid", "doc"], "full_outer")
    best = F.least(F.coalesce("rank_a", F.lit(10**6)), F.coalesce("rank_b", F.lit(10**6)))
    w = Window.partitionBy("qid").orderBy(best, F.col("doc"))
    return p.withColumn("pool_order", F.row_number().over(w))


def coverage_bounds(run_a: DataFrame, run_b: DataFrame, qrels: DataFrame, threshold: int = 1,
                    depth: int = 20, digits: int = 4) -> DataFrame:
    """EV14 + EV15 + EV16 + UN3: per need pooled/unjudged counts, bounds of
    ΔP@k (k = 5, 10) when every unjudged grade may take any value, and the
    gate status ('pending' while anything is unjudged)."""
    shared = _shared(qrels)
    p = pool(run_a, run_b, depth)
    keys = ["doc"] if shared else ["qid", "doc"]
    p = p.join(qrels.select(*keys, "rel"), keys, "left")
    judged = F.col("rel").isNotNull()
    rel = judged & (F.col("rel") >= threshold)
    aggs = [
        F.count(F.lit(1)).alias("pooled"),
        F.count_if(~judged).alias("unjudged"),
        F.count_if(~judged & F.col("rank_a").isNotNull()).alias("unjudged_a"),
        F.count_if(~judged & F.col("rank_b").isNotNull()).alias("unjudged_b"),
    ]
    for k in (5, 10):
        in_a = F.coalesce(F.col("rank_a") <= k, F.lit(False))
        in_b = F.coalesce(F.col("rank_b") <= k, F.lit(False))
        only_a, only_b = in_a & ~in_b, in_b & ~in_a
        delta = F.count_if(only_b & rel) - F.count_if(only_a & rel)
        aggs += [
            F.round((delta - F.count_if(only_a & ~judged)) / float(k), digits).alias(f"dp{k}_min"),
            F.round((delta + F.count_if(only_b & ~judged)) / float(k), digits).alias(f"dp{k}_max"),
        ]
    out = p.groupBy("qid").agg(*aggs)
    return out.withColumn("status", F.when(F.col("unjudged") > 0, F.lit("pending")).otherwise(F.lit("final")))


def rrf(runs: DataFrame, k: int = 60) -> DataFrame:
    """WR13: reciprocal-rank fusion Σ 1/(k + rank) per (qid, doc) over runs."""
    return runs.groupBy("qid", "doc").agg(F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("score"))


def upsert(existing: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """UN2: updated rows replace existing ones with the same key; existing
    rows outside the updates are kept."""
    kept = existing.join(updates.select(*key), list(key), "left_anti")
    return updates.unionByName(kept, allowMissingColumns=True)
