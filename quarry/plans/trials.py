"""Controlled one-change trials (IR14 + EV17): ten ranking variants per
need, restricted to already-judged documents (statistics stay
corpus-wide), scored with exponential-gain nDCG, P@5, P@10, AP, R@20 and
RR@10. Each ranking component is cross-checked by its own registered query
(bm25_topk, bm25_multifield, phrase_pair_boost, stopword_queries,
synonym_queries, typo_queries, trigram_search, rerank_top20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import text as T
from ..operators import evaluate as EV
from ..operators import search as SR
from ..sources.tables import Tables
from .query_edits import TYPOS, _expand, _remove_request_words, edited_needs
from .registry import register
from .retrieval import FIELD_WEIGHTS, corpus_index, corpus_positions, needs, overview, plot

TRIALS = (
    "A", "fields", "phrases", "fields+phrases", "fields+stops", "fields+synonyms",
    "fields+grams", "fields/typos", "fields+grams/typos", "rerank",
)


def _fields() -> dict[str, Column]:
    return {"overview": overview(), "plot": plot()}


def _scored(t: Tables, trial: str, judged: DataFrame) -> DataFrame:
    """(qid, doc, score) of the judged documents; rankings that nothing is
    added to leave out what cannot be in a run."""
    d = t.documents
    q = needs(t)
    if trial.endswith("/typos"):
        q = edited_needs(t, lambda c: T.replace_map(c, TYPOS))
    if "+stops" in trial:
        q = edited_needs(t, _remove_request_words)
    if "+synonyms" in trial:
        q = edited_needs(t, _expand)
    text_idx, fields_idx = corpus_index(t, "text"), corpus_index(t, "fields")
    if trial in ("A", "rerank"):
        return SR.bm25(d, "doc_id", "text", q, index=text_idx, among=judged, best=config.RUN_DEPTH).select("qid", "doc", "score")
    if trial == "phrases":
        base = SR.bm25(d, "doc_id", "text", q, index=text_idx, among=judged)
        ps = SR.phrase_scores(d, "doc_id", {"text": "text"}, q, slop=1, index=text_idx,
                              positions=corpus_positions(t, "text"), among=judged)
    elif trial == "fields+phrases":
        base = SR.bm25(d, "doc_id", _fields(), q, weights=FIELD_WEIGHTS, index=fields_idx, among=judged)
        ps = SR.phrase_scores(d, "doc_id", _fields(), q, slop=1, weights=FIELD_WEIGHTS, index=fields_idx,
                              positions=corpus_positions(t, "fields"), among=judged)
    elif "+grams" in trial:
        idx = {"stemmed": fields_idx, "overview_gram": corpus_index(t, "overview_gram"),
               "plot_gram": corpus_index(t, "plot_gram")}
        return SR.gram_search(d, "doc_id", None, q, gram_weight=0.1, fields=_fields(), weights=FIELD_WEIGHTS,
                              indexes=idx, among=judged, best=config.RUN_DEPTH)
    else:
        return SR.bm25(d, "doc_id", _fields(), q, weights=FIELD_WEIGHTS, index=fields_idx, among=judged,
                       best=config.RUN_DEPTH).select("qid", "doc", "score")
    return SR.with_boost(base, ps)


def trial_runs(t: Tables) -> DataFrame:
    """(run_id = trial, qid, doc, rank, score): top 20 among judged
    documents for every trial."""
    judged = t.labels.select(F.col("doc_id").alias("doc")).distinct()
    runs = None
    for trial in TRIALS:
        top = SR.top_k(_scored(t, trial, judged), config.RUN_DEPTH)
        if trial == "rerank":
            top = SR.rerank(top.select("qid", "doc", "rank", "score"), t.documents, "doc_id", overview(), needs(t))
        r = top.select(F.lit(trial).alias("run_id"), "qid", "doc", "rank", "score")
        runs = r if runs is None else runs.unionByName(r)
    return runs


@register("trial_matrix")
def trial_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR14 + EV17: per trial and need the fixed-candidate metrics (nDCG
    with gain 2^g - 1)."""
    t = Tables(spark, sf_dir)
    pq = EV.per_query(trial_runs(t), EV.grades_from_labels(t.labels), needs(t), list(TRIALS))
    return pq.select(
        F.col("run_id").alias("trial"), "qid", "p5", "p10", "ap", F.col("ndcg10_exp").alias("ndcg10"),
        "recall20", "rr10",
    )
