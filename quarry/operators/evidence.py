"""Judging evidence: matched terms and keyword-in-context windows.

All of it is per-row column expressions (``transform`` / ``aggregate``):
occurrence positions come from splitting the lower-cased text on the quoted
term, and the greedy non-overlapping window choice is a left fold over the
candidates (terms in order, then positions in order).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import text as T


def need_terms(need: Column, stopwords: Iterable[str] | None = None) -> Column:
    """Distinct lower-case words of a need (stopwords removed), in order of
    first occurrence."""
    words = config.ANALYZER_STOPWORDS if stopwords is None else tuple(stopwords)
    stop = F.array(*[F.lit(w) for w in words]).cast("array<string>")
    toks = F.regexp_extract_all(F.lower(need), F.lit(config.TOKEN_PATTERN), 0)
    return F.array_distinct(F.filter(toks, lambda t: ~F.array_contains(stop, t)))


def matched_terms(text: Column, terms: Column) -> Column:
    """FN18: terms contained in the text, case-folded, not word-bounded."""
    return T.substring_matches(F.coalesce(text, F.lit("")), terms)


def _starts(low: Column, term: Column) -> Column:
    """0-based starts of the non-overlapping left-to-right occurrences."""
    parts = F.split(low, F.concat(F.lit("\\Q"), term, F.lit("\\E")), -1)
    k = F.size(parts) - F.lit(1)
    L = F.length(term)
    init = F.struct(F.lit(0).alias("off"), F.array().cast("array<int>").alias("starts"))
    fold = F.aggregate(
        F.filter(parts, lambda p, i: i < k),
        init,
        lambda acc, p: F.struct(
            (acc["off"] + F.length(p) + L).alias("off"),
            F.array_append(acc["starts"], acc["off"] + F.length(p)).alias("starts"),
        ),
        lambda acc: acc["starts"],
    )
    return fold


def context_windows(df: DataFrame, text: str, terms: str, out: str, width: int = 260,
                    limit: int = 4) -> DataFrame:
    """FN19: adds ``out`` = up to ``limit`` snippets around term occurrences
    (terms in order, each occurrence widened by width/2 on both sides); a
    window that overlaps an accepted one is skipped; '...' marks cut ends.

    The cleaned text, its lower-case copy and its length are computed once
    per row in their own projection (lambdas only reference them), so the
    regex work is not repeated per term or per occurrence."""
    half = width // 2
    staged = (
        df.withColumn("_kw_clean", T.collapse_ws(F.coalesce(F.col(text), F.lit(""))))
        .withColumn("_kw_low", F.lower("_kw_clean"))
        .withColumn("_kw_n", F.length("_kw_clean"))
    )
    low, n = F.col("_kw_low"), F.col("_kw_n")
    cands = F.flatten(
        F.transform(
            F.filter(F.col(terms), lambda t: F.length(t) > F.lit(0)),
            lambda t: F.transform(
                _starts(low, F.lower(t)),
                lambda s: F.struct(
                    F.greatest(F.lit(0), s - F.lit(half)).alias("start"),
                    F.least(n, s + F.length(t) + F.lit(half)).alias("end"),
                ),
            ),
        )
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")
    staged = staged.withColumn("_kw_cands", cands)
    chosen = F.aggregate(
        F.col("_kw_cands"), empty,
        lambda acc, c: F.when(
            (F.size(acc) < F.lit(limit))
            & ~F.exists(acc, lambda a: (c["start"] < a["end"]) & (c["end"] > a["start"])),
            F.array_append(acc, c),
        ).otherwise(acc),
    )
    staged = staged.withColumn("_kw_chosen", chosen)
    clean = F.col("_kw_clean")
    snippets = F.transform(
        F.col("_kw_chosen"),
        lambda w: F.concat(
            F.when(w["start"] > 0, F.lit("...")).otherwise(F.lit("")),
            T.py_strip(clean.substr(w["start"] + F.lit(1), w["end"] - w["start"])),
            F.when(w["end"] < n, F.lit("...")).otherwise(F.lit("")),
        ),
    )
    return staged.withColumn(out, snippets).drop("_kw_clean", "_kw_low", "_kw_n", "_kw_cands", "_kw_chosen")


def plot_evidence(df: DataFrame, plot: str, overview: str, terms: str, out: str,
                  width: int = 300, limit: int = 3) -> DataFrame:
    """FN21: windows from the long field, else from the short one."""
    df = context_windows(df, plot, terms, "_pe_main", width, limit)
    df = context_windows(df, overview, terms, "_pe_alt", width, limit)
    return df.withColumn(out, F.when(F.size("_pe_main") > 0, F.col("_pe_main")).otherwise(F.col("_pe_alt"))).drop(
        "_pe_main", "_pe_alt"
    )


def child_evidence(df: DataFrame, text: str, label: str, terms: str, out: str, width: int = 280) -> DataFrame:
    """FN20 (one child): ``[label] first window`` or null."""
    df = context_windows(df, text, terms, "_ce_w", width, 1)
    return df.withColumn(
        out, F.when(F.size("_ce_w") > 0, F.concat(F.lit("["), F.col(label), F.lit("] "), F.col("_ce_w")[0]))
    ).drop("_ce_w")
