"""SQL fragments (DuckDB dialect) that mirror the Spark column expressions.

They are used only for the independent cross-check of every registered
query; the Spark jobs never run these strings.
"""

from __future__ import annotations

from collections.abc import Iterable

from .. import config


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def fold(expr: str) -> str:
    out = f"translate(lower({expr}), {q(config.FOLD_FROM)}, {q(config.FOLD_TO)})"
    for a, b in config.MULTI_FOLDS:
        out = f"replace({out}, {q(a)}, {q(b)})"
    return out


def raw_tokens(expr: str) -> str:
    return f"regexp_extract_all({fold(expr)}, {q(config.TOKEN_PATTERN)})"


def stop_list(stopwords: Iterable[str] | None = None) -> str:
    words = config.ANALYZER_STOPWORDS if stopwords is None else tuple(stopwords)
    return "[" + ", ".join(q(w) for w in words) + "]::VARCHAR[]"


def stem(t: str) -> str:
    return (
        f"CASE WHEN suffix({t}, 'ies') AND NOT suffix({t}, 'eies') AND NOT suffix({t}, 'aies') "
        f"THEN substr({t}, 1, length({t}) - 3) || 'y' "
        f"WHEN suffix({t}, 'es') AND NOT suffix({t}, 'aes') AND NOT suffix({t}, 'ees') AND NOT suffix({t}, 'oes') "
        f"THEN substr({t}, 1, length({t}) - 1) "
        f"WHEN suffix({t}, 's') AND NOT suffix({t}, 'us') AND NOT suffix({t}, 'ss') "
        f"THEN substr({t}, 1, length({t}) - 1) "
        f"ELSE {t} END"
    )


def analyze(expr: str, stopwords: Iterable[str] | None = None) -> str:
    stop = stop_list(stopwords)
    kept = f"list_filter({raw_tokens(expr)}, lambda x: NOT list_contains({stop}, x))"
    return f"list_transform({kept}, lambda x: {stem('x')})"


def analyzed_length(expr: str, stopwords: Iterable[str] | None = None) -> str:
    stop = stop_list(stopwords)
    return f"len(list_filter({raw_tokens(expr)}, lambda x: NOT list_contains({stop}, x)))"


def token_rows(table: str, key: str, text: str, stopwords: Iterable[str] | None = None,
               extra_cols: str = "") -> str:
    """(key, pos, term) rows with positions counted before stopword removal;
    stopwords dropped, terms stemmed."""
    stop = stop_list(stopwords)
    extra = (extra_cols + ", ") if extra_cols else ""
    return (
        f"SELECT {extra}{key} AS k, pos, {stem('tok')} AS term FROM ("
        f"SELECT {extra}{key}, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM ("
        f"SELECT {extra}{key}, {raw_tokens(text)} AS toks FROM {table})) "
        f"WHERE NOT list_contains({stop}, tok)"
    )


# --- scalar text functions (mirror quarry.functions.text) ------------------

from ..functions.text import NON_WS_SQL as NON_WS  # noqa: E402
from ..functions.text import WS_SQL as WS  # noqa: E402


def py_strip(e: str) -> str:
    return f"regexp_replace({e}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def blank_to_null(e: str) -> str:
    return f"nullif({py_strip(e)}, '')"


def strip_markup(e: str) -> str:
    c = f"regexp_replace({e}, '<[^>]+>', '', 'g')"
    c = f"regexp_replace({c}, {q('(?m)^' + WS + '*[*]' + WS + '+')}, '', 'g')"
    c = f"regexp_replace({c}, {q(r'[*][*](.*?)[*][*]')}, '\\1', 'g')"
    c = f"regexp_replace({c}, {q('_(.*?)_')}, '\\1', 'g')"
    return py_strip(c)


def word_count(e: str) -> str:
    return f"len(regexp_extract_all({e}, {q(NON_WS + '+')}))"


def collapse_ws(e: str) -> str:
    return py_strip(f"regexp_replace({e}, {q(WS + '+')}, ' ', 'g')")


def strip_footnotes(e: str) -> str:
    return py_strip(f"regexp_replace({e}, {q(r'[[](?:[0-9]+|[a-z])[]]')}, '', 'g')")


from ..functions.text import FLOAT_LITERAL  # noqa: E402


def safe_double(e: str, zero_to_null: bool = False) -> str:
    s = py_strip(f"CAST({e} AS VARCHAR)")
    v = f"CASE WHEN regexp_full_match({s}, {q(FLOAT_LITERAL)}) THEN TRY_CAST(replace({s}, '_', '') AS DOUBLE) END"
    if zero_to_null:
        v = f"nullif({v}, 0.0)"
    return v


def safe_long(e: str, zero_to_null: bool = False) -> str:
    d = safe_double(e)
    v = f"CASE WHEN abs({d}) < 9.2e18 THEN CAST(trunc({d}) AS BIGINT) END"
    if zero_to_null:
        v = f"nullif({v}, 0)"
    return v


def char_ngrams(t: str, n: int = 3) -> str:
    grams = f"list_transform(range(1, greatest(length({t}) - {n - 1}, 1) + 1), lambda i: substr({t}, i, {n}))"
    return f"list_filter({grams}, lambda g: length(g) = {n})"


def unstemmed(expr: str, stopwords: Iterable[str] | None = None) -> str:
    stop = stop_list(stopwords)
    return f"list_filter({raw_tokens(expr)}, lambda x: NOT list_contains({stop}, x))"


def gram_terms(expr: str, n: int = 3, stopwords: Iterable[str] | None = None) -> str:
    return f"flatten(list_transform({unstemmed(expr, stopwords)}, lambda w: {char_ngrams('w', n)}))"
