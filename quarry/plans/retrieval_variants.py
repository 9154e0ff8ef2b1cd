"""Registered retrieval variants: match counts, minimum-should-match,
filters, phrases, word-pair boost, best child record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import analyze as A
from ..operators import search as SR
from ..operators.joins import bounded_broadcast
from ..sources.tables import Tables
from . import bm25_sql as B
from . import sqlgen as S
from .registry import register
from .retrieval import _run_columns, corpus_index, corpus_positions, needs

A_SQL = "WITH " + B.run_a_sql("a_")

# --- SQL helpers for positions ---------------------------------------------

NEED_POS_SQL = S.token_rows(f"({B.NEEDS_SQL})", "qid", "text")
BIGRAMS_SQL = (
    f"SELECT qid, idx, t1, t2, gap FROM (SELECT k AS qid, CAST(row_number() OVER w - 1 AS INTEGER) AS idx, term AS t1, "
    f"lead(term) OVER w AS t2, lead(pos) OVER w - pos AS gap FROM ({NEED_POS_SQL}) WINDOW w AS (PARTITION BY k ORDER BY pos)) "
    f"WHERE t2 IS NOT NULL"
)


def _occ_sql(bg: str, slop: int) -> str:
    dp = S.token_rows("documents", "doc_id", "text")
    return (
        f"dp AS (SELECT * FROM ({dp}) WHERE term IN (SELECT t1 FROM {bg} UNION SELECT t2 FROM {bg})), "
        f"occ AS (SELECT bg.qid, bg.idx, bg.gap, p1.k AS doc, p2.pos - p1.pos AS dist FROM dp p1 JOIN {bg} bg ON p1.term = bg.t1 "
        f"JOIN dp p2 ON p2.k = p1.k AND p2.term = bg.t2 AND p2.pos BETWEEN p1.pos + bg.gap AND p1.pos + bg.gap + {int(slop)})"
    )


# --- queries ----------------------------------------------------------------


@register("bm25_num_found", A_SQL + " SELECT qid, count(*) AS num_found FROM a_scored GROUP BY qid")
def bm25_num_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR16: documents matching each need before the top-k cut."""
    t = Tables(spark, sf_dir)
    return SR.num_found(SR.bm25(t.documents, "doc_id", "text", needs(t), index=corpus_index(t, "text")))


@register(
    "bm25_min_match",
    "WITH " + B.term_scores_sql("documents", "doc_id", {"text": "text"}, B.query_terms_sql(B.NEEDS_SQL), p="a_")
    + ", " + B.scored_sql(3, "a_") + ", " + B.ranked_sql("a_scored", p="a_") + " " + B.RUN_SELECT.format(p="a_"),
)
def bm25_min_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR9: minimum-should-match 3 distinct query terms."""
    t = Tables(spark, sf_dir)
    return _run_columns(SR.top_k(SR.bm25(t.documents, "doc_id", "text", needs(t), min_match=3,
                                         index=corpus_index(t, "text"))))


_SOURCES = [f"src{i}" for i in range(1, 11)]
_FILTER_SQL = (
    "lang = 'en' AND source IN (" + ", ".join(f"'{s}'" for s in _SOURCES) + ") AND n_chars BETWEEN 500 AND 20000"
)


def _doc_filter():
    return (F.col("lang") == "en") & F.col("source").isin(*_SOURCES) & F.col("n_chars").between(500, 20000)


@register(
    "bm25_filtered",
    A_SQL + f", f_scored AS (SELECT qid, doc, sum(s) AS score FROM a_ts WHERE doc IN (SELECT doc_id FROM documents WHERE {_FILTER_SQL}) "
    "GROUP BY qid, doc), " + B.ranked_sql("f_scored", p="f_") + " " + B.RUN_SELECT.format(p="f_"),
)
def bm25_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF11 + PF13 + PF14 + IR11: exact-value, disjunction and range filters
    restrict results; idf/avgdl stay corpus-wide. The filter is evaluated
    in the same scan as tokenization (no extra join)."""
    t = Tables(spark, sf_dir)
    return _run_columns(SR.top_k(SR.bm25(t.documents, "doc_id", "text", needs(t), keep=_doc_filter())))


def _phrase_docs(t: Tables) -> DataFrame:
    bg = SR.query_bigrams(needs(t))
    return SR.phrase_occurrences(None, bg, 0, positions=corpus_positions(t, "text")).select("qid", "doc").distinct()


@register(
    "phrase_filter",
    f"WITH bg AS ({BIGRAMS_SQL}), {_occ_sql('bg', 0)} "
    "SELECT DISTINCT qid, doc AS doc_id FROM occ",
)
def phrase_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF10 + PF11 + IR2 + IR8: documents containing any of a need's word pairs
    as a phrase (the position gap of a removed stopword is kept)."""
    return _phrase_docs(Tables(spark, sf_dir)).select("qid", F.col("doc").alias("doc_id"))


@register(
    "negated_phrase",
    A_SQL + f", bg AS ({BIGRAMS_SQL}), {_occ_sql('bg', 0)}, "
    "n_scored AS (SELECT * FROM a_scored s WHERE NOT EXISTS (SELECT 1 FROM occ WHERE occ.qid = s.qid AND occ.doc = s.doc)), "
    + B.ranked_sql("n_scored", p="n_") + " " + B.RUN_SELECT.format(p="n_"),
)
def negated_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF12: ranking without documents containing any of the need's phrases
    (left anti by document)."""
    t = Tables(spark, sf_dir)
    scored = SR.bm25(t.documents, "doc_id", "text", needs(t), index=corpus_index(t, "text"))
    return _run_columns(SR.top_k(SR.without(scored, _phrase_docs(t))))


@register(
    "range_and_term",
    f"SELECT lang, count(*) AS n FROM documents WHERE n_chars BETWEEN 1000 AND 5000 "
    f"AND list_contains({S.analyze('text')}, 'tion') GROUP BY lang",
)
def range_and_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF9 + PF13 + DQ4: inclusive numeric range AND analyzed-term filter,
    counted per exact value."""
    d = Tables(spark, sf_dir).documents
    return (
        d.filter(F.col("n_chars").between(1000, 5000) & F.array_contains(A.analyze("text"), "tion"))
        .groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    )


_PAIR_SQL = (
    A_SQL + f", bg AS ({BIGRAMS_SQL}), {_occ_sql('bg', 1)}, "
    "pf AS (SELECT qid, idx, doc, sum(1.0 / (1 + dist - gap)) AS pf FROM occ GROUP BY qid, idx, doc), "
    f"lens AS (SELECT doc_id AS doc, {S.analyzed_length('text')} AS dl FROM documents), "
    "ps AS (SELECT qid, doc, sum(s) AS s FROM (SELECT pf.qid, pf.idx, pf.doc, "
    "(ln(1 + (n_docs - d1.df + 0.5) / (d1.df + 0.5)) + ln(1 + (n_docs - d2.df + 0.5) / (d2.df + 0.5))) * pf / "
    f"(pf + {config.BM25_K1!r} * ({1.0 - config.BM25_B!r} + {config.BM25_B!r} * dl / avgdl)) AS s "
    "FROM pf JOIN bg USING (qid, idx) JOIN lens USING (doc) CROSS JOIN a_stats "
    "JOIN a_dfs d1 ON d1.term = bg.t1 JOIN a_dfs d2 ON d2.term = bg.t2) GROUP BY qid, doc), "
    "p_scored AS (SELECT s.qid, s.doc, s.score + coalesce(ps.s, 0.0) AS score FROM a_scored s LEFT JOIN ps USING (qid, doc)), "
    + B.ranked_sql("p_scored", p="p_") + " " + B.RUN_SELECT.format(p="p_")
)


@register("phrase_pair_boost", _PAIR_SQL)
def phrase_pair_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR7: adjacent word-pair phrase boost with slop 1 added to BM25."""
    t = Tables(spark, sf_dir)
    scored = SR.bm25(t.documents, "doc_id", "text", needs(t), index=corpus_index(t, "text"))
    ps = SR.phrase_scores(t.documents, "doc_id", {"text": "text"}, needs(t), slop=1,
                          index=corpus_index(t, "text"), positions=corpus_positions(t, "text"))
    return _run_columns(SR.top_k(SR.with_boost(scored, ps)))


_CHILD_KEY = "CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)"
_BEST_CHILD_SQL = (
    "WITH " + B.term_scores_sql("conversations", _CHILD_KEY, {"child": "text"}, B.query_terms_sql(B.NEEDS_SQL), p="c_")
    + ", " + B.scored_sql(1, "c_")
    + ", par AS (SELECT qid, CAST(split_part(doc, ':', 1) AS BIGINT) AS doc, max(score) AS score FROM c_scored GROUP BY ALL), "
    + B.ranked_sql("par", p="par_")
)


def _best_child(t: Tables, k: int = config.RUN_DEPTH) -> DataFrame:
    return SR.top_k(SR.best_child(t.conversations, "conv_id", "turn", "text", needs(t)), k)


@register(
    "best_child_topk",
    _BEST_CHILD_SQL + " SELECT qid, doc AS conv_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM par_ranked",
)
def best_child_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR10 + JN11 + AG29: child records scored with child statistics; a
    parent's score is its best child's; top 20 parents per need."""
    r = _best_child(Tables(spark, sf_dir))
    return r.select("qid", F.col("doc").alias("conv_id"), F.col("rank").cast("int"), F.round("score", 4).alias("score"))


@register(
    "children_of_parent",
    _BEST_CHILD_SQL + " SELECT p.qid, c.conv_id, c.turn, c.role FROM par_ranked p JOIN conversations c ON c.conv_id = p.doc WHERE p.rank <= 5",
)
def children_of_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN12: all child records of the parents a query selects (top 5 per
    need). The parent set is bounded by needs x 5 and broadcast after a
    size check."""
    t = Tables(spark, sf_dir)
    top = _best_child(t, 5).select("qid", F.col("doc").alias("conv_id"))
    return t.conversations.select("conv_id", "turn", "role").join(bounded_broadcast(top), "conv_id").select(
        "qid", "conv_id", "turn", "role"
    )
