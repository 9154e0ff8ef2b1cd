"""Quality rules: a decision list learned by sequential covering.

Numeric statistics of each text are computed in one pass. From labelled rows
``learn`` covers the bad class rule by rule: a rule grows, condition by
condition, on one part of the rows by information gain, is pruned on the
other part, and joins the list while it is precise enough there. The list is
emitted as ordered Spark conditional expressions (``verdict``), so applying it
is a projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens

# Rows the rules are fitted on: the labelled documents with the smallest id
# hashes, at most so many.
LEARN_ROWS = 20_000
MAX_RULES = 24
MAX_CONDITIONS = 4
LEAST_PRECISION = 0.9
LEAST_COVER = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
    "digit_share", "mark_share", "distinct_share", "lone_symbol_share", "words_per_line",
)

_KIND = {name: np.zeros(256, bool) for name in ("symbol", "upper", "digit", "mark", "line")}
_KIND["symbol"][list(b"#*$%&|<>")] = True
_KIND["upper"][65:91] = True
_KIND["digit"][48:58] = True
_KIND["mark"][list(b"!?.,;:")] = True
_KIND["line"][10] = True


def _dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def _count(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(mask)))[at])


def _repeated_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a 3-word window found twice or more."""
    joint, at = tokens.windows(hashes, bounds, 3)
    key = tokens.mix(joint ^ (tokens.owners(bounds)[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.zeros(len(hashes) + 1, bool)
    for i in range(3):
        hit[at[again] + i] = True
    return _count(hit[:-1], bounds)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in tokens.blocks(batch.column(1)):
            n = len(b.bounds) - 1
            hashes = tokens.word_hashes(b, lower=False)
            words = np.diff(b.bounds)
            lead = (b.data & 0xC0) != 0x80
            chars = _count(lead & ~tokens._SPACE[b.data], b.offsets)
            kinds = {k: _count(m[b.data], b.offsets) for k, m in _KIND.items()}
            raw = b.data.tobytes()
            lines, dup = np.array([_dup_lines(raw[b.offsets[i]:b.offsets[i + 1]]) for i in range(n)]).T
            repeat = _repeated_words(hashes, b.bounds)
            own = tokens.owners(b.bounds)
            distinct = np.bincount(own[np.unique(tokens.mix(hashes ^ (own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), return_index=True)[1]], minlength=n)
            lone = (b.end - b.start == 1) & _KIND["symbol"][b.data[b.start]] if len(b.start) else np.zeros(0, bool)
            w, c = np.maximum(words, 1), np.maximum(chars, 1)
            columns = [words, chars, kinds["symbol"], dup, repeat, chars / w, kinds["symbol"] / w, dup / np.maximum(lines, 1),
                       repeat / w, kinds["upper"] / c, kinds["digit"] / c, kinds["mark"] / w, distinct / w, _count(lone, b.bounds) / w,
                       words / np.maximum(lines, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(b.first, n), *(pa.array(x) for x in columns)], ["_row", *COUNTS, *FEATURES])


def statistics(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``_row`` (a struct of the carried columns), the counts and features of
    every row. A null text counts as empty: all counts are 0. A text without
    words has n_words 0; shares are over at least one word, character or line,
    so they are never null."""
    row = F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)])
    frame = docs.select(row.alias("_row"), F.col(text).alias("_text"))
    schema = f"_row {frame.schema['_row'].dataType.simpleString()}, " + ", ".join(
        [f"{c} long" for c in COUNTS] + [f"{c} double" for c in FEATURES])
    return frame.mapInArrow(_statistics, schema)


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        x = rows[self.feature].to_numpy()
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, rows: pd.DataFrame) -> np.ndarray:
    out = np.ones(len(rows), bool)
    for c in rule:
        out &= c.holds(rows)
    return out


def _grow(rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """Add the condition of the largest information gain until the rule covers
    no good row or nothing is gained."""
    rule: Rule = ()
    inside = np.ones(len(rows), bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        if not n0 or not p0:
            break
        best, gain = None, 1e-9
        for feature in FEATURES:
            x, y = rows[feature].to_numpy()[inside], bad[inside]
            order = np.argsort(x, kind="stable")
            xs, pos = x[order], np.cumsum(y[order])
            cut = np.flatnonzero(xs[:-1] < xs[1:])
            for above in (False, True):
                p = pos[-1] - pos[cut] if above else pos[cut]
                n = (len(xs) - 1 - cut if above else cut + 1) - p
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1)
                if len(g) and g.max() > gain:
                    i = int(g.argmax())
                    gain, best = float(g[i]), Condition(feature, above, float((xs[cut[i]] + xs[cut[i] + 1]) / 2))
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(rows)
    return rule


def _prune(rule: Rule, rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """The prefix of the rule that is best on rows it has not grown on."""
    def worth(r: Rule) -> float:
        inside = _covers(r, rows)
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:i] for i in range(1, len(rule) + 1)), key=worth, default=())


def learn_rules(rows: pd.DataFrame, bad: np.ndarray) -> list[Rule]:
    """Ordered rules for the bad class. Every third row is held out of growing
    and decides about pruning and acceptance. No rows or no bad rows: no rules."""
    rules: list[Rule] = []
    held = np.arange(len(rows)) % 3 == 2
    left = np.ones(len(rows), bool)
    while len(rules) < MAX_RULES:
        grow, prune = left & ~held, left & held
        if bad[grow].sum() < LEAST_COVER or not bad[prune].any():
            break
        rule = _prune(_grow(rows[grow], bad[grow]), rows[prune], bad[prune])
        if not rule:
            break
        for part, enough in ((grow, LEAST_COVER), (prune, 1)):
            inside = _covers(rule, rows[part])
            if bad[part][inside].sum() < max(enough, LEAST_PRECISION * inside.sum()):
                return rules
        rules.append(rule)
        left &= ~_covers(rule, rows)
    return rules


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> list[Rule]:
    """Fit the rules on at most LEARN_ROWS labelled rows that pass the base
    rules. ``labels`` holds key and quality (0 bad, 1 good); of several labels
    of a key the lowest counts, null keys and null labels are left out."""
    asked = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_quality"))
    asked = asked.withColumn("_order", F.xxhash64("_key")).orderBy("_order", "_key").limit(LEARN_ROWS)
    found = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(asked), "_key")
    rows = statistics(found, "_text", ["_key", "_quality", "_order"]).where(~base_failed())
    rows = rows.select("_row.*", *FEATURES).orderBy("_order", "_key", *FEATURES).limit(LEARN_ROWS).toPandas()
    return learn_rules(rows, (rows["_quality"] == 0).to_numpy())


def verdict(rules: list[Rule]) -> Column:
    """1-based number of the first rule that rejects the row, else 0."""
    out = None
    for i, rule in enumerate(rules, 1):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``_row``, counts, features, base_failed, rule and kept for every row.
    Repeated rows are judged alike; an empty table gives an empty result."""
    rows = statistics(docs, text, carry)
    rows = rows.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
