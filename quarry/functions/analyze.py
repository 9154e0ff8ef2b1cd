"""Text analyzer as Spark column expressions (no Python UDF).

Chain, identical for documents and queries:
  lower -> accent fold -> word tokens -> stopword removal -> light stem.

Positions are assigned before stopword removal so phrase distances keep the
gap of a removed stopword.

Stemmer: Harman's S-stemmer (1991), first matching rule only:
  "ies" -> "y"  unless the word ends in "eies" or "aies"
  "es"  -> "e"  unless the word ends in "aes", "ees" or "oes"
  "s"   -> ""   unless the word ends in "us" or "ss"
Known gap against a dictionary stemmer: "investigating" stays as is.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fold(col: Column | str) -> Column:
    """Lower-case and strip accents (letters only, never changes token
    boundaries). ASCII texts have no accents to look for."""
    low = F.lower(_c(col))
    c = F.translate(low, config.FOLD_FROM, config.FOLD_TO)
    for a, b in config.MULTI_FOLDS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.when(F.octet_length(_c(col)) == F.char_length(_c(col)), low).otherwise(c)


# The tokens of config.TOKEN_PATTERN in lower-cased text: ASCII characters are
# looked up in a table first, and nothing found is given back.
_WORD = r"[[abcdefghijklmnopqrstuvwxyz0123456789_][\p{L}\p{N}]]++"
_TOKENS = rf"{_WORD}(?:['’.]{_WORD})*+"


def raw_tokens(col: Column | str) -> Column:
    """Folded word tokens in text order, stopwords included (array<string>)."""
    return F.regexp_extract_all(fold(col), F.lit(_TOKENS), 0)


def stopword_array(stopwords: Iterable[str] | None = None) -> Column:
    words = config.ANALYZER_STOPWORDS if stopwords is None else tuple(stopwords)
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def is_stopword(term: Column, stopwords: Iterable[str] | None = None) -> Column:
    """Looked up in a set of the words, not along a list of them."""
    return term.isin(*(config.ANALYZER_STOPWORDS if stopwords is None else tuple(stopwords)))


def stem(term: Column) -> Column:
    """Harman S-stemmer (see module doc)."""
    n = F.length(term)
    return (
        F.when(
            term.endswith("ies") & ~term.endswith("eies") & ~term.endswith("aies"),
            F.concat(term.substr(F.lit(1), n - 3), F.lit("y")),
        )
        .when(
            term.endswith("es") & ~term.endswith("aes") & ~term.endswith("ees") & ~term.endswith("oes"),
            term.substr(F.lit(1), n - 1),
        )
        .when(
            term.endswith("s") & ~term.endswith("us") & ~term.endswith("ss"),
            term.substr(F.lit(1), n - 1),
        )
        .otherwise(term)
    )


def analyze(col: Column | str, stopwords: Iterable[str] | None = None) -> Column:
    """Analyzed terms of a text (array<string>), stopwords removed, stemmed."""
    kept = F.filter(raw_tokens(col), lambda t: ~is_stopword(t, stopwords))
    return F.transform(kept, stem)


def analyzed_length(col: Column | str, stopwords: Iterable[str] | None = None) -> Column:
    """Field length = number of analyzed terms (stopwords do not count)."""
    return F.size(F.filter(raw_tokens(col), lambda t: ~is_stopword(t, stopwords)))


def char_ngrams(term: Column, n: int = 3) -> Column:
    """Token-internal character n-grams (array<string>) in order; a term
    shorter than n gives none."""
    grams = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(term) - (n - 1), F.lit(1))),
        lambda i: term.substr(i, F.lit(n)),
    )
    return F.filter(grams, lambda g: F.length(g) == n)
