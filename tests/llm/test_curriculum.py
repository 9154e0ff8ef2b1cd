import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from quarry.llm import curriculum, spread

ROWS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])
FADE, GROW, LEVEL = [(0, 4), (1, 2)], [(0, 0), (1, 2)], [(0, 2), (0.5, 2), (1, 2)]


def shared(sizes, weights, share, repeats):
    """Water filling, one round of resharing after another."""
    target, full = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(repeats * sizes[s] for s in full)
        total = sum(w for s, w in weights.items() if s not in full)
        target = {s: repeats * sizes[s] if s in full else left * w / total for s, w in weights.items()}
        above = {s for s in weights if s not in full and target[s] > repeats * sizes[s]}
        if not above:
            return target
        full |= above


def integral(knots, t):
    out = 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        x = min(max(t - t0, 0), t1 - t0)
        out += x * (w0 + w0 + (w1 - w0) * x / (t1 - t0)) / 2
    return out


@pytest.fixture(scope="module")
def rows(prose):
    out = [(i, prose(i, 20 + 37 * i % 400), "ba"[i % 2] if i % 3 else "hot") for i in range(60)]
    out += [(100, prose(1, 900), "few"), (101, None, "none"), (102, "", "none"), (103, " \t\n", None), (104, " x   y", None), (105, "a b c", None), (None, "q r", "b"), (None, "s", "b"), (7, "a b", "c"), (7, "a b", "c"), (8, "a b c d", "d"), (9, "b c d e", "e")]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS).selectExpr("*", "1 as size", "'x' as target", "2 as weight", "3 as copy")


@pytest.mark.parametrize("share, repeats", [(1.5, 2.0), (0.3, 2.0), (5.0, 2.0), (1.0, 1.0), (2.5, 3.0)])
def test_targets_taken_and_positions(spark, rows, share, repeats):
    schedules = [FADE, GROW, LEVEL]
    got = curriculum.plan(frame(spark, rows), schedules, share, repeats).collect()
    sizes = defaultdict(int)
    for _, text, s in rows:
        sizes[s] += len(re.findall("[^ \t-\r]+", text or ""))
    knots = {s: schedules[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    want = shared(sizes, {s: (3, 1, 2)[schedules.index(k)] for s, k in knots.items()}, share, repeats)
    taken, docs = defaultdict(int), set()
    for r in got:
        s = None if r._null else r._source
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-12, abs_tol=1e-9)
        taken[s] += r.words or 0
        docs.add(r._row)
        assert (r.copy is None) == (r.position is None) and (r.words is None or 0 < r.words <= r.size)
    assert len(docs) == len(rows)
    assert all(taken[s] == math.floor(want[s] + 0.5) for s in sizes)
    for s, k in knots.items():  # the demand at each copy's position is the middle of the copy
        before = 0
        for r in sorted((r for r in got if r.copy is not None and (None if r._null else r._source) == s), key=lambda r: r.position):
            at = integral(k, r.position) / integral(k, 1) * math.floor(want[s] + 0.5)
            assert math.isclose(at, before + r.words / 2, rel_tol=1e-6, abs_tol=1e-3)
            before += r.words
    positions = [r.position for r in got if r.position is not None]
    assert all(0 <= p <= 1 for p in positions)


def test_equal_sources_share_equally(spark, prose):
    got = curriculum.plan(frame(spark, [(i, prose(3, 40), f"s{i % 5}") for i in range(20)]), [LEVEL], 1.25, 2.0).collect()
    assert {r.target for r in got} == {200.0}


def test_range_sorted_and_repeatable(spark, rows, monkeypatch, tmp_path):
    keep = ["doc_id", "_source", "words", "position"]
    ordered = curriculum.plan(frame(spark, rows), [FADE, GROW, LEVEL]).withColumnRenamed("_key", "doc_id").select(*keep)
    ordered.write.parquet(str(tmp_path / "mix"))
    first = ordered.collect()
    placed = [r.position for r in first if r.position is not None]
    assert placed == sorted(placed)
    monkeypatch.setattr(spread, "BROADCAST_ROWS", 0)
    again = curriculum.plan(frame(spark, rows).repartition(5), [FADE, GROW, LEVEL]).withColumnRenamed("_key", "doc_id").select(*keep)
    key = lambda r: tuple((x is None, x) for x in r)
    same = [r for r in first if r.doc_id not in (None, 7)]
    assert sorted((r for r in again.collect() if r.doc_id not in (None, 7)), key=key) == sorted(same, key=key)


def test_no_words(spark):
    assert curriculum.plan(frame(spark, []), [LEVEL]).collect() == []
    got = curriculum.plan(frame(spark, [(1, None, None), (2, " ", "x")]), [LEVEL]).collect()
    assert [(r.target, r.copy) for r in got] == [(0.0, None)] * 2


def test_native(spark, rows):
    text = curriculum.plan(frame(spark, rows), [LEVEL])._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
