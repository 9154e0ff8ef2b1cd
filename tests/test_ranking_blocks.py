"""Terms counted and needs scored for many texts at once give what the
expressions of one text and joins of rows give."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry import config
from quarry.functions import analyze as A
from quarry.functions import counting as C
from quarry.functions import scoring as SC
from quarry.operators import search as SR

TEXTS = [
    "River boats of the river, the Straße naïve don’t a.b..c 'x' s es ies", "", "東京 races Σίσυφος İstanbul boats", "Æon øre É_1 ²½ ªº 9.5. river",
    "boat boat boat race", "\x00a\nb\tboats the", "races’s r.s 'q' ’ of", "x" * 40 + " y", "the of and",
] + [f"a{chr(c)}b {chr(c)} {chr(c)}x" for c in [*range(0x80, 0x250, 7), 0x130, 0x131, 0x178, 0x2019, 0x2028, 0x20AC, 0x1E9E, 0x2071, 0xFF21]]


def docs(spark, rows=None):
    return spark.createDataFrame(rows or [(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")


def needs(spark):
    return spark.createDataFrame([(1, "river boat river"), (2, "boats race the"), (3, "naïve Straße 東京"), (4, "zzz"), (None, "river")], "qid long, text string")


def test_tokens_of_every_simple_character(spark):
    chars = [chr(c) for a, b in C._RANGES for c in range(a, b + 1)]
    texts = [f"a{x}b {x} {x}c d{x}" for x in chars] + [f"a{x}{y}b" for x in "'’.é_-" for y in "'’.ß1 "]
    want = [r.t for r in docs(spark, list(enumerate(texts))).select("doc_id", A.raw_tokens("text").alias("t")).orderBy("doc_id").collect()]
    found, place = C.tokens(texts)
    got = [[] for _ in texts]
    for t, i in zip(found.to_pylist(), place.tolist(), strict=True):
        got[i].append(t)
    assert got == want
    assert docs(spark, list(enumerate(texts))).where(~F.col("text").rlike(C.SIMPLE)).isEmpty()
    assert docs(spark, [(1, "İ"), (2, "Σ"), (3, "東"), (4, "\U0001d400")]).where(F.col("text").rlike(C.SIMPLE)).isEmpty()


@pytest.mark.parametrize("block", [C.BLOCK_CHARS, 7])
def test_counts_are_those_of_the_expressions(spark, monkeypatch, block):
    texts = SR.field_texts(docs(spark), "doc_id", {"text": "text"})
    rows = [{"field": "text", "doc": i, "text": t, "tokens": None, "_keep": True} for i, t in enumerate(TEXTS)]
    simple = {r.doc_id for r in docs(spark).where(F.col("text").rlike(C.SIMPLE)).collect()}
    raw = {r.doc: r.t for r in texts.select("doc", A.raw_tokens("text").alias("t")).collect()}
    for r in rows:
        if r["doc"] not in simple:
            r.update(text=None, tokens=raw[r["doc"]])
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("field", pa.string()), ("doc", pa.int64()), ("text", pa.string()), ("tokens", pa.list_(pa.string())), ("_keep", pa.bool_())]))
    assert 0 < len(simple) < len(rows)
    monkeypatch.setattr(C, "BLOCK_CHARS", block)
    grams = SR.gram_analyzer(3)
    for of_tokens, expression in ((C.stems(), A.analyze("text")), (C.grams(3), grams(F.col("text")))):
        want = {}
        for r in texts.select("doc", expression.alias("t")).collect():
            want |= {(r.doc, None, len(r.t), 1): 1} | {(r.doc, x, len(r.t), r.t.count(x)): 1 for x in r.t}
        got = [(r["doc"], r["term"], r["dl"], r["tf"]) for b in C.counter(of_tokens)([batch]) for r in b.to_pylist()]
        assert sorted(got, key=str) == sorted(want, key=str)
        lists = [r for b in C.counter(of_tokens, lists=True)([batch]) for r in b.to_pylist()]
        assert [r["doc"] for r in lists] == [*range(len(TEXTS))]
        assert {(r["doc"], x, r["dl"], n) for r in lists for x, n in zip(r["terms"], r["tfs"], strict=True)} == {k for k in want if k[1] is not None}
    placed = {r["doc"]: r["terms"] for b in C.placer(C.stems())([batch]) for r in b.to_pylist()}
    stem = texts.select("doc", F.transform(A.raw_tokens("text"), lambda t: F.when(~A.is_stopword(t), A.stem(t))).alias("t"))
    assert placed == {r.doc: r.t for r in stem.collect()}


def found(df):
    return {(r.qid, r.doc): round(r.score, 9) for r in df.collect()}


ROWS = {
    "once": [(i, t) for i, t in enumerate(TEXTS)],
    "repeated": [(1, "river boat"), (1, "boat river"), (2, "races"), (2, "river races boats"), (None, "river"), (None, "boat boat"), (3, None), (4, "")],
}


@pytest.mark.parametrize("kind", ROWS)
def test_rankings_of_blocks_are_those_of_joins(spark, tmp_path, monkeypatch, kind):
    d, q = docs(spark, ROWS[kind]), needs(spark)
    # a document's terms reach the scorer in several blocks
    monkeypatch.setattr(SC, "BLOCK_ROWS", 5)
    monkeypatch.setattr(SC, "BLOCK_CELLS", 200)
    fields = {"head": F.substring_index("text", " ", 1), "all": F.col("text")}
    weights = {"head": 3.0, "all": 1.0}
    for name, build in (("rows", SR.build_index), ("lists", SR.build_lists)):
        build(d, "doc_id", fields).write.parquet(f"{tmp_path}/{name}")
        for f, c in fields.items():
            build(d, "doc_id", {f + "_gram": c}, analyzer=SR.gram_analyzer(3)).write.parquet(f"{tmp_path}/{name}_{f}_gram")
        build(d, "doc_id", {"text": "text"}).write.parquet(f"{tmp_path}/{name}_text")
    read = lambda x: spark.read.parquet(f"{tmp_path}/{x}")
    among = spark.createDataFrame([(i,) for i in range(0, 30, 2)], "doc long")
    indexes = lambda x: {"stemmed": read(x), **{f + "_gram": read(f"{x}_{f}_gram") for f in fields}}
    got = []
    for held, name in ((config.HELD_TERMS, "lists"), (config.HELD_TERMS, "rows"), (0, "lists")):
        monkeypatch.setattr(config, "HELD_TERMS", held)
        got.append([
            found(SR.bm25(d, "doc_id", "text", q, min_match=2, index=read(f"{name}_text"))),
            found(SR.gram_search(d, "doc_id", None, q, fields=fields, weights=weights, indexes=indexes(name), among=among)),
        ])
    assert got[0] == got[1] == got[2] and all(got[0])
    assert all(doc in range(0, 30, 2) for _, doc in got[0][1])


def test_best_leaves_a_ranking_as_it_is(spark, monkeypatch):
    rows = [(i, " ".join(["river"] * (i % 5) + ["boat"] * (i % 3) + ["race"] * (i % 2) + ["x"] * (i % 7))) for i in range(300)]
    d, q = docs(spark, rows), needs(spark)
    monkeypatch.setattr(SC, "BLOCK_CELLS", 100)
    index = SR.build_lists(d, "doc_id", {"text": "text"}).coalesce(1)
    grams = {"stemmed": index, "text_gram": SR.build_lists(d, "doc_id", {"text_gram": "text"}, analyzer=SR.gram_analyzer(3))}
    # the n-grams of "naive" reach "river", its word reaches nothing
    for rows_of, run in (12, lambda best: SR.bm25(d, "doc_id", "text", q, index=index, best=best)), (16, lambda best: SR.gram_search(d, "doc_id", F.col("text"), q, indexes=grams, best=best)):
        whole, pruned = run(None), run(4)
        ranked = [{(r.qid, r.doc, r.rank) for r in SR.top_k(x, 4).collect()} for x in (whole, pruned)]
        assert ranked[0] == ranked[1] and len(ranked[0]) == rows_of
        assert pruned.count() < whole.count()


def test_rows_near_the_last_place_are_kept():
    best = SC.Best(1, 2)
    first = best.among(np.array([[True, True, True]]), np.array([[3.0, 1.0, 2.0]]))
    later = best.among(np.array([[True, True, False]]), np.array([[2.0 - 1e-6, 1.9, 9.0]]))
    assert first.tolist() == [[True, False, True]] and later.tolist() == [[True, False, False]]


def test_listed_indexes_are_never_made_into_rows_of_postings(spark, tmp_path):
    """trigram_search, trigram_typo_search, trial_matrix: postings stay in their
    text's row, and only a row per text is shuffled."""
    d = docs(spark)
    SR.build_lists(d, "doc_id", {"text": "text"}).write.parquet(f"{tmp_path}/text")
    SR.build_lists(d, "doc_id", {"text_gram": "text"}, analyzer=SR.gram_analyzer(3)).write.parquet(f"{tmp_path}/gram")
    index, gram = spark.read.parquet(f"{tmp_path}/text"), spark.read.parquet(f"{tmp_path}/gram")
    ranked = SR.gram_search(d, "doc_id", F.col("text"), needs(spark), indexes={"stemmed": index, "text_gram": gram})
    for run in (ranked, SR.bm25(d, "doc_id", "text", needs(spark), index=index)):
        plan = re.sub(r"#\d+L?", "", run._jdf.queryExecution().executedPlan().toString())
        assert "MapInArrow" in plan and "HashAggregate" not in plan and "Generate" not in plan and "Join" not in plan
        assert plan.count("Exchange hashpartitioning(doc") == 1
        assert any("/matched-" in f for f in run.inputFiles())
