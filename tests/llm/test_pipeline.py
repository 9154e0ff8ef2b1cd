"""The pipeline against its stages' rules worked out in plain Python, where
the learned parts are taken from the models themselves."""

import itertools

import corpus_pipeline
import pyarrow as pa
from quarry.llm import decontamination, language, pieces
from quarry.llm.queries import vocabulary
from quarry.llm.spread import ARROW_ROWS

from .test_near_duplicates import sets_of
from .test_quality_rules import brute


def test_stages_keep_clean_documents_and_drop_the_others(spark, docs_of, prose, tmp_path):
    base = [(i, prose(i, 120), "aa") for i in range(30)]
    item = prose(500, 40)
    odd = [(100, base[0][1] + " tail", "aa"), (101, prose(40, 20), "aa"), (102, "x y z " * 60, "aa"), (103, " ".join(f"{i}!" for i in range(90)), None), (104, prose(41, 100) + " " + item, "aa"), (105, None, None)]
    docs = spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in base + odd + base[3:4]], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    left = {i: t for i, t, _ in base + odd if not brute(t)[-1]}
    left = {i: t for i, t in left.items() if any(c.isalpha() for c in t)}
    for a, b in itertools.combinations(sorted(left), 2):
        if a in left and b in left and 100 * len(sets_of(left[a]) & sets_of(left[b])) >= 75 * len(sets_of(left[a]) | sets_of(left[b])):
            del left[b]
    grams = {tuple(w) for w in zip(*(decontamination.words_of(item)[k:] for k in range(13)))}
    left = {i: t for i, t in left.items() if not grams & set(zip(*(decontamination.words_of(t)[k:] for k in range(13))))}
    assert set(left) == set(range(30))

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    with open(vocabulary(), "rb") as f:
        model = pieces.Pieces(f.read())
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((i, model.encode(t).tolist()) for i, t in left.items())
    at = docs
    for _, step in corpus_pipeline.STAGES[:-1]:
        at = step(spark, at, str(tmp_path))
        assert at.columns == docs.columns
    assert language.UNKNOWN == "und"


def test_near_dedup_decides_by_id_and_text(spark, prose):
    a, b, c, d, e, f, g, h, k = (prose(900 + i, 60) for i in range(9))
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (None, c + " tail"),  # null ids: a copy, two texts, near copies
            (2, d), (5, d), (5, e),  # an id with a copy and a unique text
            (6, f), (6, g), (6, g),  # an id with two unique texts, one repeated
            (7, h), (7, h + " end"), (8, k), (8, k),
            (None, None), (None, None), (None, ""), (9, None), (9, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    one_of = lambda i, *texts: [(j, t) for j, t in got if j == i and t in texts]
    near = one_of(None, c, c + " tail") + one_of(7, h, h + " end")
    assert [i for i, _ in near] == [None, 7]
    want = [(1, a), (None, b), (2, d), (5, e), (6, f), (6, g), (8, k), (None, None), (None, ""), (9, None), (9, "")]
    assert sorted(map(repr, got)) == sorted(map(repr, want + near))
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").collect() == []


def test_stages_hand_texts_to_python_in_small_batches(spark):
    at = "spark.sql.execution.arrow.maxRecordsPerBatch"
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    old = spark.conf.get(at)
    try:
        for set_to, most in (("10000", ARROW_ROWS), ("0", ARROW_ROWS), ("500", 500)):
            spark.conf.set(at, set_to)
            corpus_pipeline.language_id(spark, docs, "")
            assert spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0] == most
    finally:
        spark.conf.set(at, old)
