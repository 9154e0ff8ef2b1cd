"""DuckDB SQL builder mirroring ``operators.search`` (cross-check only).

Every builder returns CTE definitions whose names carry a prefix ``p`` so
several rankings can live in one statement.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from .. import config
from . import sqlgen as S

NEEDS_SQL = "SELECT item_id AS qid, text FROM benchmark"
OVERVIEW_SQL = "split_part(text, chr(10), 1)"
PLOT_SQL = "CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END"


def query_terms_sql(query_select: str, stopwords: Iterable[str] | None = None) -> str:
    """``query_select`` yields (qid, text)."""
    return (
        f"SELECT qid, term, count(*) AS qtf FROM ("
        f"SELECT qid, unnest({S.analyze('text', stopwords)}) AS term FROM ({query_select})) "
        f"GROUP BY qid, term"
    )


def field_texts_sql(table: str, key: str, fields: Mapping[str, str]) -> str:
    parts = [
        f"SELECT {key} AS doc, {S.q(name)} AS field, CAST({expr} AS VARCHAR) AS text FROM {table}"
        for name, expr in fields.items()
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE text IS NOT NULL"


def term_scores_sql(table: str, key: str, fields: Mapping[str, str], qterms_sql: str,
                    weights: Mapping[str, float] | None = None,
                    k1: float = config.BM25_K1, b: float = config.BM25_B,
                    stopwords: Iterable[str] | None = None, p: str = "",
                    candidates: str | None = None, word: bool = False,
                    gram: int | None = None) -> str:
    """CTE definitions ending in ``{p}ts(qid, doc, term, s)`` (with ``word``
    when the query terms carry one). ``gram``: n-gram analyzer."""
    if gram:
        terms_of = lambda e: S.gram_terms(e, gram, stopwords)
        len_of = lambda e: f"len({S.gram_terms(e, gram, stopwords)})"
    else:
        terms_of = lambda e: S.analyze(e, stopwords)
        len_of = lambda e: S.analyzed_length(e, stopwords)
    wc = "word, " if word else ""
    weights = dict(weights or {})
    wcase = "1.0"
    if weights:
        wcase = "CASE " + " ".join(f"WHEN field = {S.q(n)} THEN {float(w)!r}" for n, w in weights.items()) + " ELSE 1.0 END"
    multi = len(fields) > 1
    cand = f" JOIN {candidates} USING (qid, doc)" if candidates else ""
    ts = (
        f"SELECT qid, doc, {wc}term, {'max(s)' if multi else 's'} AS s FROM ("
        f"SELECT qid, doc, {wc}term, field, qtf * ({wcase}) * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf / "
        f"(tf + {k1!r} * ({1.0 - b!r} + {b!r} * dl / avgdl)) AS s "
        f"FROM {p}post JOIN {p}dfs USING (field, term) JOIN {p}stats USING (field) JOIN {p}qt USING (term){cand})"
        + (f" GROUP BY qid, doc, {wc}term" if multi else "")
    )
    return (
        f"{p}qt AS ({qterms_sql}), "
        f"{p}texts AS ({field_texts_sql(table, key, fields)}), "
        f"{p}stats AS (SELECT field, count(*) AS n_docs, avg(CAST({len_of('text')} AS DOUBLE)) AS avgdl FROM {p}texts GROUP BY field), "
        f"{p}occ AS (SELECT doc, field, len(terms) AS dl, unnest(terms) AS term FROM ("
        f"SELECT doc, field, {terms_of('text')} AS terms FROM {p}texts)), "
        f"{p}post AS (SELECT field, term, doc, dl, count(*) AS tf FROM {p}occ WHERE term IN (SELECT term FROM {p}qt) GROUP BY field, term, doc, dl), "
        f"{p}dfs AS (SELECT field, term, count(*) AS df FROM {p}post GROUP BY field, term), "
        f"{p}ts AS ({ts})"
    )


def scored_sql(min_match: int = 1, p: str = "") -> str:
    return (
        f"{p}scored AS (SELECT qid, doc, sum(s) AS score, count(*) AS matched FROM {p}ts "
        f"GROUP BY qid, doc HAVING count(*) >= {int(min_match)})"
    )


def ranked_sql(src: str, k: int = config.RUN_DEPTH, score: str = "score",
               precision: int = 6, p: str = "") -> str:
    return (
        f"{p}ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY "
        f"round({score}, {precision}) DESC, doc ASC) AS rank FROM {src}) WHERE rank <= {int(k)})"
    )


def run_a_sql(p: str = "a_", needs_sql: str = NEEDS_SQL, k: int = config.RUN_DEPTH) -> str:
    """Setup A: single-field BM25 over the whole text, top k."""
    return (
        term_scores_sql("documents", "doc_id", {"text": "text"}, query_terms_sql(needs_sql), p=p)
        + ", " + scored_sql(1, p) + ", " + ranked_sql(f"{p}scored", k, p=p)
    )


def run_b_sql(p: str = "b_", a: str = "a_", needs_sql: str = NEEDS_SQL, depth: int = config.RUN_DEPTH,
              weight: float = 1.0) -> str:
    """Setup B: rerank the top ``depth`` of A by adding ``weight`` x the
    overview-field score (corpus-wide statistics), then re-sort."""
    cand = f"{p}cand"
    return (
        f"{cand} AS (SELECT qid, doc FROM {a}ranked WHERE rank <= {depth}), "
        + term_scores_sql("documents", "doc_id", {"overview": OVERVIEW_SQL}, query_terms_sql(needs_sql),
                          p=p, candidates=cand)
        + f", {p}s2 AS (SELECT qid, doc, sum(s) AS s2 FROM {p}ts GROUP BY qid, doc), "
        f"{p}new AS (SELECT r.qid, r.doc, CASE WHEN r.rank <= {depth} THEN r.score + {float(weight)!r} * coalesce(s2.s2, 0.0) "
        f"ELSE r.score END AS score FROM {a}ranked r LEFT JOIN {p}s2 s2 USING (qid, doc)), "
        + ranked_sql(f"{p}new", config.RUN_DEPTH, p=p)
    )


RUN_SELECT = "SELECT qid, doc AS doc_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM {p}ranked"
