"""Registered evaluation queries: runs A and B from the tables, judgments
from ``labels`` (shared by every need), trec_eval-style metrics, pooling,
coverage bounds, fusion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import evaluate as EV
from ..operators import search as SR
from ..sources.tables import Tables
from . import bm25_sql as B
from .registry import register
from .retrieval import needs, stored_run

# --- shared SQL -------------------------------------------------------------

RUNS_SQL = (
    "WITH " + B.run_a_sql("a_") + ", " + B.run_b_sql("b_", "a_") + ", "
    "runs AS (SELECT 'A' AS run_id, qid, doc, rank, score FROM a_ranked UNION ALL "
    "SELECT 'B', qid, doc, rank, score FROM b_ranked), "
    "qrels AS (SELECT doc_id AS doc, CASE WHEN quality = 1 AND toxic = 0 THEN 2 WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END AS rel FROM labels), "
    "st AS (SELECT count(*) AS n_judged, count(*) FILTER (WHERE rel >= 1) AS n_relevant, count(*) FILTER (WHERE rel > 0) AS n_positive FROM qrels), "
    "ideal AS (SELECT rel, row_number() OVER (ORDER BY rel DESC, doc) AS p FROM (SELECT * FROM qrels WHERE rel > 0 ORDER BY rel DESC, doc LIMIT 10)), "
    "idcg AS (SELECT sum(rel / log2(p + 1)) AS idcg, sum((pow(2, rel) - 1) / log2(p + 1)) AS idcg_exp FROM ideal), "
    "g AS (SELECT r.*, q.rel, CASE WHEN coalesce(q.rel, 0) >= 1 THEN 1 ELSE 0 END AS isrel FROM runs r LEFT JOIN qrels q USING (doc)), "
    "h AS (SELECT *, sum(isrel) OVER (PARTITION BY run_id, qid ORDER BY rank ROWS UNBOUNDED PRECEDING) AS hits FROM g) "
)

PER_QUERY_SQL = RUNS_SQL + (
    ", agg AS (SELECT run_id, qid, count(*) AS retrieved, sum(isrel) AS rel_retrieved, count(*) FILTER (WHERE rel IS NULL) AS unjudged, "
    "count(*) FILTER (WHERE isrel = 1 AND rank <= 5) AS h5, count(*) FILTER (WHERE isrel = 1 AND rank <= 10) AS h10, "
    "count(*) FILTER (WHERE isrel = 1 AND rank <= 20) AS h20, sum(CASE WHEN isrel = 1 THEN hits / rank END) AS apsum, "
    "max(CASE WHEN isrel = 1 AND rank <= 10 THEN 1.0 / rank END) AS rr, "
    "sum(CASE WHEN rank <= 10 THEN coalesce(rel, 0) / log2(rank + 1) END) AS dcg, "
    "sum(CASE WHEN rank <= 10 THEN (pow(2, coalesce(rel, 0)) - 1) / log2(rank + 1) END) AS dcg_exp FROM h GROUP BY run_id, qid), "
    "base AS (SELECT item_id AS qid, run_id FROM benchmark, (VALUES ('A'), ('B')) v(run_id)), "
    "pq AS (SELECT run_id, qid, CAST(coalesce(retrieved, 0) AS BIGINT) AS retrieved, CAST(coalesce(rel_retrieved, 0) AS BIGINT) AS rel_retrieved, "
    "CAST(coalesce(unjudged, 0) AS BIGINT) AS unjudged, round(coalesce(h5, 0) / 5.0, 4) AS p5, round(coalesce(h10, 0) / 10.0, 4) AS p10, "
    "round(CASE WHEN n_relevant > 0 THEN coalesce(apsum, 0.0) / n_relevant END, 4) AS ap, "
    "round(CASE WHEN n_positive > 0 THEN coalesce(dcg, 0.0) / idcg END, 4) AS ndcg10, "
    "round(CASE WHEN n_relevant > 0 THEN coalesce(h20, 0) / n_relevant END, 4) AS recall20, "
    "round(CASE WHEN n_relevant > 0 THEN coalesce(rr, 0.0) END, 4) AS rr10, "
    "round(CASE WHEN n_positive > 0 THEN coalesce(dcg_exp, 0.0) / idcg_exp END, 4) AS ndcg10_exp "
    "FROM base LEFT JOIN agg USING (run_id, qid), st, idcg) "
)


def _runs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Setups A and B as saved runs (SC14 sink / SC6 scan): computed from
    the tables once, then read by every evaluation, as runs are files the
    evaluation consumes."""
    return stored_run(t, "A"), stored_run(t, "B")


def _labelled(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.withColumn("run_id", F.lit("A")).unionByName(b.withColumn("run_id", F.lit("B")))


def _per_query(t: Tables) -> DataFrame:
    a, b = _runs(t)
    qrels = EV.grades_from_labels(t.labels)
    return EV.per_query(_labelled(a, b), qrels, needs(t), ["A", "B"])


@register("metrics_per_query", PER_QUERY_SQL + "SELECT * FROM pq")
def metrics_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV4-EV9 + EV12 + EV13 + JN10: per need and setup: P@5, P@10, AP,
    nDCG@10 (linear and exponential gain), Recall@20, RR@10."""
    return _per_query(Tables(spark, sf_dir))


_METRICS = ("p5", "p10", "ap", "ndcg10", "recall20", "rr10")


@register(
    "metrics_mean_delta",
    PER_QUERY_SQL
    + ", m AS (SELECT run_id, " + ", ".join(f"avg({x}) AS {x}" for x in _METRICS) + " FROM pq GROUP BY run_id), "
    "l AS (SELECT run_id, metric, value FROM m UNPIVOT INCLUDE NULLS (value FOR metric IN (" + ", ".join(_METRICS) + "))) "
    "SELECT metric, round(max(CASE WHEN run_id = 'A' THEN value END), 4) AS mean_a, round(max(CASE WHEN run_id = 'B' THEN value END), 4) AS mean_b, "
    "round(max(CASE WHEN run_id = 'B' THEN value END) - max(CASE WHEN run_id = 'A' THEN value END), 4) AS delta FROM l GROUP BY metric",
)
def metrics_mean_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG33 + EV18: macro means per setup (nulls skipped) and B - A."""
    return EV.mean_and_delta(_per_query(Tables(spark, sf_dir)), "A", "B")


_PR_SQL = RUNS_SQL + (
    ", pr AS (SELECT run_id, qid, recall, round(coalesce(max(CASE WHEN hits >= floor(recall * n_relevant + 0.5) THEN hits / rank END), 0.0), 4) AS precision "
    "FROM (SELECT h.*, n_relevant, unnest([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]::DOUBLE[]) AS recall FROM h, st WHERE n_relevant > 0) "
    "GROUP BY run_id, qid, recall) "
)


@register("pr_curve_11pt", _PR_SQL + "SELECT * FROM pr")
def pr_curve_11pt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV10: 11-point interpolated precision per need and setup."""
    t = Tables(spark, sf_dir)
    a, b = _runs(t)
    return EV.pr_curve(_labelled(a, b), EV.grades_from_labels(t.labels))


@register(
    "pr_curve_mean",
    _PR_SQL + "SELECT run_id, recall, round(avg(precision), 4) AS mean_precision FROM pr GROUP BY run_id, recall",
)
def pr_curve_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV11: mean interpolated precision per recall level."""
    t = Tables(spark, sf_dir)
    a, b = _runs(t)
    pr = EV.pr_curve(_labelled(a, b), EV.grades_from_labels(t.labels))
    return pr.groupBy("run_id", "recall").agg(F.round(F.avg("precision"), 4).alias("mean_precision"))


_POOL_SQL = (
    "WITH " + B.run_a_sql("a_") + ", " + B.run_b_sql("b_", "a_") + ", "
    "pool AS (SELECT qid, doc, a.rank AS rank_a, b.rank AS rank_b, a.score AS score_a, b.score AS score_b "
    "FROM (SELECT qid, doc, rank, score FROM a_ranked) a FULL OUTER JOIN (SELECT qid, doc, rank, score FROM b_ranked) b USING (qid, doc)), "
    "pooled AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY least(coalesce(rank_a, 1000000), coalesce(rank_b, 1000000)), doc) AS pool_order FROM pool), "
    "qrels AS (SELECT doc_id AS doc, CASE WHEN quality = 1 AND toxic = 0 THEN 2 WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END AS rel FROM labels) "
)


def _pool(t: Tables) -> DataFrame:
    a, b = _runs(t)
    return EV.pool(a, b, config.RUN_DEPTH)


@register(
    "pool_depth20",
    _POOL_SQL + "SELECT qid, doc AS doc_id, CAST(rank_a AS INTEGER) AS rank_a, CAST(rank_b AS INTEGER) AS rank_b, "
    "round(score_a, 4) AS score_a, round(score_b, 4) AS score_b, CAST(pool_order AS INTEGER) AS pool_order FROM pooled",
)
def pool_depth20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV1 + JN9 + UN1 + WR8: depth-20 pool of both setups."""
    p = _pool(Tables(spark, sf_dir))
    return p.select(
        "qid", F.col("doc").alias("doc_id"), F.col("rank_a").cast("int"), F.col("rank_b").cast("int"),
        F.round("score_a", 4).alias("score_a"), F.round("score_b", 4).alias("score_b"),
        F.col("pool_order").cast("int"),
    )


@register(
    "judgment_sheet",
    _POOL_SQL + "SELECT qid, doc AS doc_id, printf('%.6f', coalesce(score_a, score_b)) AS score, '' AS rel, '' AS judge, '' AS notes FROM pooled",
)
def judgment_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV2 + FN22: blank judgment sheet for the pool (score to 6 decimals)."""
    p = _pool(Tables(spark, sf_dir))
    return p.select(
        "qid", F.col("doc").alias("doc_id"),
        F.format_string("%.6f", F.coalesce("score_a", "score_b")).alias("score"),
        F.lit("").alias("rel"), F.lit("").alias("judge"), F.lit("").alias("notes"),
    )


@register(
    "judgment_summary",
    _POOL_SQL + ", j AS (SELECT p.qid, q.rel FROM pooled p LEFT JOIN qrels q USING (doc)) "
    "SELECT qid, count(*) AS pooled, count(rel) AS judged, count(*) FILTER (WHERE rel >= 1) AS relevant, "
    "count(*) FILTER (WHERE rel = 0) AS grade0, count(*) FILTER (WHERE rel = 1) AS grade1, count(*) FILTER (WHERE rel = 2) AS grade2 "
    "FROM j GROUP BY ROLLUP (qid)",
)
def judgment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG31 + AG32 + AG34: per need pooled / judged / relevant / grade
    counts, plus the total row (rollup, qid null)."""
    t = Tables(spark, sf_dir)
    j = _pool(t).join(EV.grades_from_labels(t.labels), "doc", "left")
    return j.rollup("qid").agg(
        F.count(F.lit(1)).alias("pooled"), F.count("rel").alias("judged"),
        F.count_if(F.col("rel") >= 1).alias("relevant"), F.count_if(F.col("rel") == 0).alias("grade0"),
        F.count_if(F.col("rel") == 1).alias("grade1"), F.count_if(F.col("rel") == 2).alias("grade2"),
    )


@register(
    "judgment_upsert",
    _POOL_SQL
    + ", old AS (SELECT p.qid, p.doc, q.rel, 'seed' AS judge FROM pooled p JOIN qrels q USING (doc) WHERE p.rank_a IS NOT NULL), "
    "upd AS (SELECT p.qid, p.doc, l.quality AS rel, 'manual' AS judge FROM pooled p JOIN labels l ON l.doc_id = p.doc WHERE p.rank_b IS NOT NULL) "
    "SELECT qid, doc AS doc_id, CAST(rel AS INTEGER) AS rel, judge FROM upd UNION ALL "
    "SELECT qid, doc, CAST(rel AS INTEGER), judge FROM old WHERE NOT EXISTS (SELECT 1 FROM upd WHERE upd.qid = old.qid AND upd.doc = old.doc)",
)
def judgment_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UN2: new grades (pool of B, graded by quality) replace earlier ones
    (pool of A, graded by the label rubric); earlier judgments outside the
    update are kept."""
    t = Tables(spark, sf_dir)
    p = _pool(t)
    old = p.filter(F.col("rank_a").isNotNull()).join(EV.grades_from_labels(t.labels), "doc").select(
        "qid", "doc", "rel", F.lit("seed").alias("judge")
    )
    upd = p.filter(F.col("rank_b").isNotNull()).join(
        t.labels.select(F.col("doc_id").alias("doc"), F.col("quality").alias("rel")), "doc"
    ).select("qid", "doc", "rel", F.lit("manual").alias("judge"))
    out = EV.upsert(old, upd, ["qid", "doc"])
    return out.select("qid", F.col("doc").alias("doc_id"), F.col("rel").cast("int"), "judge")


@register(
    "coverage_bounds",
    _POOL_SQL
    + ", j AS (SELECT p.*, q.rel, q.rel IS NOT NULL AS judged, coalesce(q.rel >= 1, false) AS isrel, "
    "coalesce(rank_a <= 5, false) AS a5, coalesce(rank_b <= 5, false) AS b5, coalesce(rank_a <= 10, false) AS a10, coalesce(rank_b <= 10, false) AS b10 "
    "FROM pooled p LEFT JOIN qrels q USING (doc)), "
    "c AS (SELECT qid, count(*) AS pooled, count(*) FILTER (WHERE NOT judged) AS unjudged, "
    "count(*) FILTER (WHERE NOT judged AND rank_a IS NOT NULL) AS unjudged_a, count(*) FILTER (WHERE NOT judged AND rank_b IS NOT NULL) AS unjudged_b, "
    "count(*) FILTER (WHERE b5 AND NOT a5 AND isrel) - count(*) FILTER (WHERE a5 AND NOT b5 AND isrel) AS d5, "
    "count(*) FILTER (WHERE a5 AND NOT b5 AND NOT judged) AS ua5, count(*) FILTER (WHERE b5 AND NOT a5 AND NOT judged) AS ub5, "
    "count(*) FILTER (WHERE b10 AND NOT a10 AND isrel) - count(*) FILTER (WHERE a10 AND NOT b10 AND isrel) AS d10, "
    "count(*) FILTER (WHERE a10 AND NOT b10 AND NOT judged) AS ua10, count(*) FILTER (WHERE b10 AND NOT a10 AND NOT judged) AS ub10 FROM j GROUP BY qid) "
    "SELECT qid, pooled, unjudged, unjudged_a, unjudged_b, round((d5 - ua5) / 5.0, 4) AS dp5_min, round((d5 + ub5) / 5.0, 4) AS dp5_max, "
    "round((d10 - ua10) / 10.0, 4) AS dp10_min, round((d10 + ub10) / 10.0, 4) AS dp10_max, "
    "CASE WHEN unjudged > 0 THEN 'pending' ELSE 'final' END AS status FROM c",
)
def coverage_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV14 + EV15 + EV16 + UN3: unjudged coverage, bounds of ΔP@k, gate."""
    t = Tables(spark, sf_dir)
    a, b = _runs(t)
    return EV.coverage_bounds(a, b, EV.grades_from_labels(t.labels))


@register(
    "unjudged_candidates",
    _POOL_SQL + "SELECT qid, doc AS doc_id FROM pooled p WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.doc)",
)
def unjudged_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN3: pool rows without a judgment (left anti) — the only rows a
    rebuild adds to the judging sheet."""
    t = Tables(spark, sf_dir)
    judged = t.labels.select(F.col("doc_id").alias("doc"))
    return _pool(t).join(judged, "doc", "left_anti").select("qid", F.col("doc").alias("doc_id"))


@register(
    "side_by_side",
    "WITH " + B.run_a_sql("a_") + ", " + B.run_b_sql("b_", "a_") + " "
    "SELECT qid, CAST(rank AS INTEGER) AS rank, a.doc AS doc_a, b.doc AS doc_b, round(a.score, 4) AS score_a, round(b.score, 4) AS score_b "
    "FROM (SELECT qid, rank, doc, score FROM a_ranked WHERE rank <= 10) a FULL OUTER JOIN (SELECT qid, rank, doc, score FROM b_ranked WHERE rank <= 10) b USING (qid, rank)",
)
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR18: top 10 of both setups joined on (need, rank)."""
    t = Tables(spark, sf_dir)
    a, b = _runs(t)
    a = a.filter(F.col("rank") <= 10).select("qid", "rank", F.col("doc").alias("doc_a"), F.round("score", 4).alias("score_a"))
    b = b.filter(F.col("rank") <= 10).select("qid", "rank", F.col("doc").alias("doc_b"), F.round("score", 4).alias("score_b"))
    return a.join(b, ["qid", "rank"], "full_outer").select("qid", F.col("rank").cast("int"), "doc_a", "doc_b", "score_a", "score_b")


_FUSE_SQL = (
    "WITH " + B.run_a_sql("a_") + ", "
    + B.term_scores_sql("documents", "doc_id", {"overview": B.OVERVIEW_SQL, "plot": B.PLOT_SQL},
                        B.query_terms_sql(B.NEEDS_SQL), {"overview": 3.0, "plot": 1.0}, p="m_")
    + ", " + B.scored_sql(1, "m_") + ", " + B.ranked_sql("m_scored", p="m_") + ", "
    "f AS (SELECT qid, doc, sum(1.0 / (60 + rank)) AS score FROM (SELECT qid, doc, rank FROM a_ranked UNION ALL "
    "SELECT qid, doc, rank FROM m_ranked) GROUP BY qid, doc), "
    + B.ranked_sql("f", p="f_") + " " + B.RUN_SELECT.format(p="f_")
)


@register("rrf_fusion", _FUSE_SQL)
def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WR13: reciprocal-rank fusion (k = 60) of setup A and the weighted
    overview^3 + plot trial, top 20, ties by ascending id."""
    from .retrieval import _run_columns

    t = Tables(spark, sf_dir)
    both = stored_run(t, "A").unionByName(stored_run(t, "fields"))
    return _run_columns(SR.top_k(EV.rrf(both, config.RRF_K)))
