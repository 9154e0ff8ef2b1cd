import itertools

import numpy as np

from quarry.llm import language


def test_spans_und_and_extra_columns(docs_of, prose):
    train = [(i, prose(i, 80, "abcdefgh"), "aa") for i in range(20)] + [(100 + i, prose(i, 80, "ijklmnop"), "bb") for i in range(20)]
    train += [(200 + i, prose(i, 80, "абвгдежз"), "cc") for i in range(20)] + [(300, None, "aa"), (301, "abc", None)]
    model = language.learn(docs_of(train))
    assert model.langs == ["aa", "bb", "cc"]
    a, b = prose(77, 30, "abcdefgh"), prose(78, 20, "ijklmnop")
    mixed = a + " " + b
    rows = [(1, mixed), (2, prose(70, 40, "абвгдежз")), (3, None), (4, ""), (5, "12 34 !!"), (6, prose(5, 30_000, "ijklmnop")), (6, "日本語")]
    got = {(r.doc_id, r.lang) for r in language.identify(docs_of(rows), model).select("_row.doc_id", "lang").collect()}
    assert {(1, "aa"), (2, "cc"), (3, "und"), (4, "und"), (5, "und"), (6, "bb")} <= got
    spans = language.identify(docs_of(rows[:1]), model).first()["spans"]
    assert [(s["lang"], mixed[s["start"]:s["end"]]) for s in spans] == [("aa", a), ("bb", b)]
    assert language.identify(docs_of([]), model).collect() == []
    assert language.learn(docs_of([])).langs == []
    assert language.identify(docs_of(rows[:1]), language.learn(docs_of([]))).first()["lang"] == "und"


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, 3, 0, 6]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    scores = (-rng.random((15, 3)) * 30).astype(np.float32)
    label = language.viterbi(scores, bounds)
    worth = lambda path, own: sum(own[i, p] for i, p in enumerate(path)) - language.SWITCH * sum(p != q for p, q in zip(path, path[1:]))
    for lo, hi in zip(bounds, bounds[1:]):
        if hi > lo:
            best = max(worth(p, scores[lo:hi]) for p in itertools.product(range(3), repeat=int(hi - lo)))
            assert abs(worth(label[lo:hi], scores[lo:hi]) - best) < 1e-3


def test_held_out_accuracy(spark):
    from quarry.llm.queries import QUERIES

    found = QUERIES["op4_language"](spark, "/root/testdata/sf0.001")
    truth = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").where("lang is not null").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_every_letter_has_a_script(spark, docs_of, prose, tmp_path):
    import corpus_pipeline

    letters = [chr(p) for p in range(0x110000) if chr(p).isalpha()]
    data = np.frombuffer("".join(letters).encode(), np.uint8)
    ends = np.cumsum([len(c.encode()) for c in letters])
    assert language._word_scripts(data, np.append(0, ends[:-1]), ends).all()

    kinds = {"gu": "અઆઇઈઉઊએઐ", "km": "កខគឃងចឆជ", "my": "ကခဂဃငစဆဇ", "vai": "ꔀꔁꔂꔃꔄꔅꔆꔇ"}
    names = ["aa", *kinds]
    rows = [(100 * k + i, prose(100 * k + i, 60, kinds.get(x, "abcdefgh")), x) for k, x in enumerate(names) for i in range(8)]
    new = [(1000 + k, prose(1000 + k, 40, kinds[x]), None) for k, x in enumerate(kinds)]
    docs = docs_of(rows + new)
    got = {r.doc_id: (r.lang, r.score) for r in language.identify(docs, language.learn(docs)).select("_row.doc_id", "lang", "score").collect()}
    assert all(got[i] == (x, 1.0) for i, _, x in rows)
    assert [got[1000 + k] for k in range(len(kinds))] == [(x, 1.0) for x in kinds]
    mixed = prose(5, 10) + " " + prose(6, 30, kinds["gu"])
    spans = language.identify(docs_of([(1, mixed)]), language.learn(docs)).first()["spans"]
    assert [s["lang"] for s in spans] == ["aa", "gu"]
    assert corpus_pipeline.language_id(spark, docs, str(tmp_path)).count() == len(rows + new)
