"""Registered query-rewrite trials and the character-trigram field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import text as T
from ..operators import search as SR
from ..sources.tables import Tables
from . import bm25_sql as B
from . import sqlgen as S
from .registry import register
from .retrieval import _run_columns, corpus_index

# Parameters of the rewrite trials (chosen for the driver's needs table; the
# reference's own maps are movie-specific and are passed the same way).
TYPOS = {"the": "teh", "and": "adn", "with": "wiht", "that": "taht"}
EXPANSIONS = {"with": "alongside together", "that": "which"}
REQUEST_WORDS = ("this", "that", "from", "are")  # words that the needs hold
GRAM_WEIGHT = 0.1

# ASCII word boundaries written out, so Java and RE2 agree on non-ASCII text.
_L, _R = "(^|[^a-z0-9_])", "([^a-z0-9_]|$)"


def _remove_request_words(c: Column) -> Column:
    pat = "(?i)" + _L + "(" + "|".join(REQUEST_WORDS) + ")" + _R
    for _ in range(2):  # second pass catches words sharing a delimiter
        c = F.regexp_replace(c, F.lit(pat), F.lit("$1 $3"))
    return c


def _remove_request_words_sql(e: str) -> str:
    pat = "(?i)" + _L + "(" + "|".join(REQUEST_WORDS) + ")" + _R
    for _ in range(2):
        e = f"regexp_replace({e}, {S.q(pat)}, '\\1 \\3', 'g')"
    return e


def _expand(c: Column) -> Column:
    adds = [F.when(c.rlike("(?i)" + _L + w + _R), F.lit(alt)) for w, alt in EXPANSIONS.items()]
    return F.concat_ws(" ", c, *adds)


def _expand_sql(e: str) -> str:
    adds = [f"CASE WHEN regexp_matches({e}, {S.q('(?i)' + _L + w + _R)}) THEN {S.q(alt)} END" for w, alt in EXPANSIONS.items()]
    return f"concat_ws(' ', {e}, {', '.join(adds)})"


def _typos_sql(e: str) -> str:
    for a, b in TYPOS.items():
        e = f"replace({e}, {S.q(a)}, {S.q(b)})"
    return e


def edited_needs(t: Tables, edit) -> DataFrame:
    return t.benchmark.select(F.col("item_id").alias("qid"), edit(F.col("text")).alias("text"))


def _needs_sql(edit_sql) -> str:
    return f"SELECT item_id AS qid, {edit_sql('text')} AS text FROM benchmark"


def _run_sql(needs_sql: str, p: str) -> str:
    return "WITH " + B.run_a_sql(p, needs_sql) + " " + B.RUN_SELECT.format(p=p)


def _run(t: Tables, q: DataFrame) -> DataFrame:
    return _run_columns(SR.top_k(SR.bm25(t.documents, "doc_id", "text", q, index=corpus_index(t, "text"))))


@register("stopword_queries", _run_sql(_needs_sql(_remove_request_words_sql), "s_"))
def stopword_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN24: request words removed from the needs, then setup A."""
    t = Tables(spark, sf_dir)
    return _run(t, edited_needs(t, _remove_request_words))


@register("typo_queries", _run_sql(_needs_sql(_typos_sql), "t_"))
def typo_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN25: misspellings injected by an exact replacement map."""
    t = Tables(spark, sf_dir)
    return _run(t, edited_needs(t, lambda c: T.replace_map(c, TYPOS)))


@register("synonym_queries", _run_sql(_needs_sql(_expand_sql), "y_"))
def synonym_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN26: alternatives appended when a word occurs in the need."""
    t = Tables(spark, sf_dir)
    return _run(t, edited_needs(t, _expand))


def _gram_sql(needs_sql: str) -> str:
    words = (
        f"SELECT qid, word, count(*) AS qtf FROM (SELECT qid, unnest({S.unstemmed('text')}) AS word FROM ({needs_sql})) "
        f"GROUP BY qid, word"
    )
    qt_text = f"SELECT qid, word, {S.stem('word')} AS term, qtf FROM words"
    qt_gram = (
        f"SELECT qid, word, term, sum(qtf) AS qtf FROM (SELECT qid, word, qtf, unnest({S.char_ngrams('word')}) AS term "
        f"FROM words) GROUP BY qid, word, term"
    )
    return (
        f"WITH words AS ({words}), "
        + B.term_scores_sql("documents", "doc_id", {"text": "text"}, qt_text, p="t_", word=True) + ", "
        + B.term_scores_sql("documents", "doc_id", {"gram": "text"}, qt_gram, p="g_", word=True, gram=3) + ", "
        f"gw AS (SELECT qid, doc, word, sum(s) * {GRAM_WEIGHT!r} AS s FROM g_ts GROUP BY qid, doc, word), "
        "pw AS (SELECT qid, doc, word, max(s) AS s FROM (SELECT qid, doc, word, s FROM t_ts UNION ALL SELECT qid, doc, word, s FROM gw) "
        "GROUP BY qid, doc, word), gs AS (SELECT qid, doc, sum(s) AS score FROM pw GROUP BY qid, doc), "
        + B.ranked_sql("gs", p="x_") + " " + B.RUN_SELECT.format(p="x_")
    )


@register("trigram_search", _gram_sql(B.NEEDS_SQL))
def trigram_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR13: character-trigram copy of the field (weight 0.1) combined per
    query word with the stemmed field (disjunction-max)."""
    t = Tables(spark, sf_dir)
    q = edited_needs(t, lambda c: c)
    return _run_columns(SR.top_k(SR.gram_search(t.documents, "doc_id", F.col("text"), q, gram_weight=GRAM_WEIGHT,
                                                indexes=_gram_indexes(t), best=config.RUN_DEPTH)))


@register("trigram_typo_search", _gram_sql(_needs_sql(_typos_sql)))
def trigram_typo_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR13 + FN25: the trigram field on misspelled needs."""
    t = Tables(spark, sf_dir)
    q = edited_needs(t, lambda c: T.replace_map(c, TYPOS))
    return _run_columns(SR.top_k(SR.gram_search(t.documents, "doc_id", F.col("text"), q, gram_weight=GRAM_WEIGHT,
                                                indexes=_gram_indexes(t), best=config.RUN_DEPTH)))


def _gram_indexes(t: Tables) -> dict:
    return {"stemmed": corpus_index(t, "text"), "text_gram": corpus_index(t, "text_gram")}
