import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import phrases, spread


def brute(rows, longest, least, keep):
    """The definition, with Python integers."""
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    candidates = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= least}
    out = []
    for lang in totals:
        kept = []
        for (g, w), a in candidates.items():
            if g != lang:
                continue
            held = any(h == lang and len(v) > len(w) and 100 * n >= 50 * a and any(v[i:i + len(w)] == w for i in range(len(v))) for (h, v), n in candidates.items())
            if held:
                continue
            cuts = [(1_000_000 * a * a // (counts[g, w[:j]] * counts[g, w[j:]]), j, counts[g, w[:j]], counts[g, w[j:]]) for j in range(1, len(w))]
            s, _, left, right = min(cuts)
            kept.append((-s, -a, " ".join(w).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:keep])]
    return sorted(out)


def mined(frame, *args):
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in cols) for r in phrases.mine(frame, "text", "lang", *args).collect())


@pytest.fixture(scope="module")
def rows(prose):
    out = [(i, prose(i, 300, "abc").replace("ab ", "ab, ").replace("c ", "C "), ("en", "fr", None, "und")[i % 4]) for i in range(12)]
    out += [(50, "x y z " * 40 + "x y. z x\ty z", "en"), (51, None, "en"), (52, "", None), (53, "  \t\n", "fr"), (54, "é ß é ß é ß! Ünü É", "fr"), (54, "é ß é ß é ß! Ünü É", "fr"), (None, "a b a b a b", None)]
    return out


@pytest.mark.parametrize("longest, least, keep", [(3, 3, 2000), (2, 2, 7), (4, 3, 40)])
def test_equals_the_definition(docs_of, rows, longest, least, keep):
    assert mined(docs_of(rows), longest, least, keep) == brute(rows, longest, least, keep)


def test_parts_and_shuffled_joins_give_the_same(docs_of, rows, monkeypatch):
    monkeypatch.setattr(phrases, "WORDS_PART", 5)
    monkeypatch.setattr(phrases, "GROUPS_PART", 9)
    monkeypatch.setattr(phrases, "GATHERED", 10)
    monkeypatch.setattr(phrases, "VOCABULARY", 3)
    monkeypatch.setattr(spread, "BROADCAST_ROWS", 0)
    few = rows[:3] + rows[-7:]
    assert mined(docs_of(few), 3, 5, 2000) == brute(few, 3, 5, 2000)


def test_no_rows(docs_of):
    assert mined(docs_of([])) == [] and mined(docs_of([(1, "a b c", "en"), (2, None, None)])) == []


def test_score_is_exact(spark):
    values = [(10**15 - 1, 10**15 + 7, 10**15 + 9), (3, 10**12, 10**13), (9_007_199_254_740_993, 9_007_199_254_740_995, 9_007_199_254_740_997), (10, 30, 11)]
    frame = spark.createDataFrame(values, "a long, l long, r long").select("*", phrases.score("a", "l", "r").alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in frame.collect())


def test_running_totals_with_one_hot_key(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), "id", (F.col("id") % 5).alias("v"))
    got = spread.running_totals(frame, ["id"], "v", ["k"]).collect()
    sums = Counter()
    for r in sorted(got, key=lambda r: r.id):
        assert r.before == sums[r.k]
        sums[r.k] += r.v


def test_blocks_reach_python_in_bounded_batches(spark, monkeypatch):
    at, seen = "spark.sql.execution.arrow.maxBytesPerBatch", set()

    def stage(df, label, **kw):
        seen.add(int(spark.conf.get(at)))
        return spread.stage(df, label, **kw)

    monkeypatch.setattr(phrases, "stage", stage)
    old = spark.conf.get(at)
    docs = spark.createDataFrame([(1, "b c d " * 20, "en")], "doc_id long, text string, lang string")
    out = phrases.mine(docs)
    assert seen == {spread.ARROW_BYTES} and spark.conf.get(at) == old
    assert "InArrow" not in out._jdf.queryExecution().toString()  # nothing of it is left to run outside
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in out.collect())
    assert got == brute([(1, "b c d " * 20, "en")], 3, 10, 2000)


def test_rows_of_a_relation_are_read_in_place():
    parts = [phrases._related(i, np.array([1, 4, 5]), np.array([7, 8, i])) for i in range(3)]
    batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    got = [(b, p.tolist(), c.tolist()) for b, p, c in phrases._rows(batch)]
    assert got == [(i, [1, 4, 5], [7, 8, i]) for i in range(3)]
