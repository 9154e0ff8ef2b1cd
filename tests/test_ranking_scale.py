"""Rankings, phrases and n-gram scores stay where a document's postings lie,
and count repeated keys as one document of their summed terms."""

import math
import re

from pyspark.sql import functions as F

from quarry import config
from quarry.functions import analyze as A
from quarry.operators import search as SR

DOCS = [
    (1, "river boat race on the river"),
    (2, "boat of the river"),
    (2, "the river of boat"),  # same key and length: one document
    (3, "race boats"),
    (4, ""),
    (5, None),
    (None, "river race"),
]
NEEDS = [(1, "river boat river"), (2, "boat race boat"), (3, "races in the river")]


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def needs(spark):
    return spark.createDataFrame(NEEDS, "qid long, text string")


def plan(df):
    """The physical plan, without the numbers of its columns."""
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_postings_count_inside_the_row(spark):
    idx = SR.build_index(docs(spark), "doc_id", {"text": "text"})
    assert "Exchange" not in plan(idx)
    rows = {(r.term, r.tf) for r in idx.where("doc = 1").collect()}
    assert rows == {(None, 1), ("river", 2), ("boat", 1), ("race", 1)}
    assert [(r.term, r.dl) for r in idx.where("doc = 4").collect()] == [(None, 0)]


def test_full_postings_shuffle_only_repeated_keys(spark):
    once = spark.createDataFrame([(1, "river boat river"), (2, "boat")], "doc_id long, text string")
    post = SR.postings(SR.field_texts(once, "doc_id", {"text": "text"}))
    assert "Exchange" not in plan(post)
    assert {(r.term, r.doc, r.tf) for r in post.collect()} == {("river", 1, 2), ("boat", 1, 1), ("boat", 2, 1)}
    twice = SR.postings(SR.field_texts(docs(spark), "doc_id", {"text": "text"})).where("doc = 2")
    assert {(r.term, r.tf) for r in twice.collect()} == {("river", 2), ("boat", 2)}


def test_scores_are_summed_where_postings_lie(spark):
    idx = SR.build_index(docs(spark), "doc_id", {"text": "text"})
    ranked = SR.bm25(docs(spark), "doc_id", "text", needs(spark), index=idx)
    assert "hashpartitioning(qid, doc" not in plan(ranked) and "hashpartitioning(doc" in plan(ranked)
    # (doc, length): terms; the two rows of document 2 are one document
    held = {(1, 4): {"river": 2, "boat": 1, "race": 1}, (2, 2): {"river": 2, "boat": 2}, (3, 2): {"race": 1, "boat": 1},
            (4, 0): {}, (None, 2): {"river": 1, "race": 1}}
    want = {}
    avg = sum(n for _, n in held) / len(held)
    for qid, asked in ((1, {"river": 2, "boat": 1}), (2, {"boat": 2, "race": 1}), (3, {"race": 1, "river": 1})):
        for (doc, n), tf in held.items():
            for term in set(tf) & set(asked):
                df = sum(term in x for x in held.values())
                s = asked[term] * math.log(1 + (len(held) - df + 0.5) / (df + 0.5)) * tf[term] / (tf[term] + 1.2 * (0.25 + 0.75 * n / avg))
                want[qid, doc] = want.get((qid, doc), 0.0) + s
    for run in (ranked, SR.bm25(docs(spark), "doc_id", "text", needs(spark))):
        got = {(r.qid, r.doc): r.score for r in run.collect()}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_rerank_reads_a_written_ranking(spark):
    idx = SR.build_index(docs(spark), "doc_id", {"text": "text"})
    top = SR.top_k(SR.bm25(docs(spark), "doc_id", "text", needs(spark), index=idx), 3)
    again = SR.rerank(top, docs(spark), "doc_id", "text", needs(spark), depth=3, k=3)
    assert any("/ranking-" in f for f in again.inputFiles())
    assert {(r.qid, r.doc) for r in again.collect()} == {(r.qid, r.doc) for r in top.collect()}


def test_phrases_meet_real_neighbours_only(spark):
    texts = SR.field_texts(docs(spark), "doc_id", {"text": "text"})
    pairs = SR.query_bigrams(needs(spark))
    occ = SR.phrase_occurrences(texts, pairs, 1)
    assert "hashpartitioning(doc, field" not in plan(occ) and "hashpartitioning(doc" in plan(occ)
    words = {}
    for doc, text in DOCS:
        for pos, word in enumerate((text or "").split()):
            words.setdefault(doc, []).append((pos, word.rstrip("s")))
    want = sorted((q.qid, q.idx, doc, p2 - p1) for q in pairs.collect() for doc, held in words.items() if doc is not None
                  for p1, a in held for p2, b in held if a == q.t1 and b == q.t2 and 0 <= p2 - p1 - q.gap <= 1)
    assert want and sorted((r.qid, r.idx, r.doc, r.dist) for r in occ.collect()) == want


def test_boost_and_exclusion_leave_scores_in_place(spark):
    scored = spark.createDataFrame([(1, 7, 1.0), (2, 7, 2.0), (None, 7, 3.0), (1, None, 4.0)], "qid long, doc long, score double")
    scored = scored.repartition(3, "doc")
    boost = spark.createDataFrame([(1, 7, 0.5), (1, 8, 9.0), (None, 7, 9.0)], "qid long, doc long, s double")
    more, less = SR.with_boost(scored, boost), SR.without(scored, boost.select("qid", "doc"))
    assert "hashpartitioning(qid" not in plan(more) + plan(less)
    assert {tuple(r) for r in more.collect()} == {(1, 7, 1.5), (2, 7, 2.0), (None, 7, 3.0), (1, None, 4.0)}
    assert {tuple(r) for r in less.collect()} == {(2, 7, 2.0), (None, 7, 3.0), (1, None, 4.0)}


def test_word_scores_are_made_once_per_word(spark):
    found = SR.gram_search(docs(spark), "doc_id", F.col("text"), needs(spark))
    assert "hashpartitioning(qid, doc" not in plan(found) and "hashpartitioning(doc, word" not in plan(found)
    held = {(1, 4): "river boat race river", (2, 2): "boat river", (3, 2): "race boats", (4, 0): "", (None, 2): "river race"}
    twice = {(2, 2): 2}

    def table(split):
        t = {}
        for d, text in held.items():
            terms = split(text)
            t[d] = (len(terms), {x: terms.count(x) * twice.get(d, 1) for x in set(terms)})
        return t

    def score(t, d, term):
        n, tf = t[d]
        if term not in tf:
            return None
        df = sum(term in x for _, x in t.values())
        avg = sum(k for k, _ in t.values()) / len(t)
        return math.log(1 + (len(t) - df + 0.5) / (df + 0.5)) * tf[term] / (tf[term] + 1.2 * (0.25 + 0.75 * n / avg))

    grams = lambda w: [w[i:i + 3] for i in range(len(w) - 2)]
    stem = lambda w: w.rstrip("s")
    st, gt = table(lambda x: [stem(w) for w in x.split()]), table(lambda x: [g for w in x.split() for g in grams(w)])
    want = {}
    for qid, asked in ((1, ["river", "boat", "river"]), (2, ["boat", "race", "boat"]), (3, ["races", "river"])):
        for w in asked:
            for d in held:
                g = [score(gt, d, x) for x in grams(w)]
                best = [v for v in (score(st, d, stem(w)), 0.1 * sum(x for x in g if x is not None) if any(x is not None for x in g) else None) if v is not None]
                if best:
                    want[qid, d[0]] = want.get((qid, d[0]), 0.0) + max(best)
    got = {(r.qid, r.doc): r.score for r in found.collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_terms_are_counted_by_runs(spark):
    texts = ["s's s ss as s", "a.b a.b a b.a aa a.b", "x " * 3000 + "xs y", "the of", "es s es boats boat"]
    idx = SR.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", {"text": "text"})
    assert "lambdafunction" not in plan(idx).split("Generate inline")[0]  # counts are made without functions of the row
    stop = {"a", "as", "the", "of"}

    def stem(w):
        for end, back, put, but in (("ies", 3, "y", ("eies", "aies")), ("es", 1, "", ("aes", "ees", "oes")), ("s", 1, "", ("us", "ss"))):
            if w.endswith(end) and not w.endswith(but):
                return w[:-back] + put
        return w

    want = set()
    for doc, text in enumerate(texts):
        terms = [stem(w) for w in text.split() if w not in stop]
        want |= {(doc, None, len(terms), 1)} | {(doc, x, len(terms), terms.count(x)) for x in terms}
    assert {tuple(r) for r in idx.select("doc", "term", "dl", "tf").collect()} == want
    assert idx.count() == len(want)


def test_phrases_of_single_rows_shuffle_no_position(spark):
    rows = [(1, "river the boat race"), (2, "boat of river boat"), (3, ""), (None, "river boat")]
    once = spark.createDataFrame(rows, "doc_id long, text string")
    index = SR.build_position_index(once, "doc_id", {"text": "text"})
    pairs = SR.query_bigrams(spark.createDataFrame([(1, "river the boat"), (2, "river boat race")], "qid long, text string"))
    occ = SR.phrase_occurrences(None, pairs, 1, positions=index)
    assert "hashpartitioning(doc" not in plan(occ) and "Window" not in plan(occ).split("BroadcastExchange")[0]
    assert sorted((r.qid, r.idx, r.doc, r.dist) for r in occ.collect()) == [(1, 0, 1, 2), (2, 0, 1, 2), (2, 0, 2, 1), (2, 1, 1, 1)]


def test_rankings_search_an_index_once(spark, tmp_path):
    SR.build_index(docs(spark), "doc_id", {"text": "text"}).write.parquet(str(tmp_path / "index"))
    ranked = SR.bm25(docs(spark), "doc_id", "text", needs(spark), index=spark.read.parquet(str(tmp_path / "index")))
    files = ranked.inputFiles()
    assert any("/matched-" in f for f in files) and not any("/index/" in f for f in files)
    assert {(r.qid, r.doc) for r in ranked.collect()} == {(q, d) for q in (1, 2, 3) for d in (1, 2, 3, None)}


def test_best_field_is_found_before_the_needs(spark):
    fields, weights = {"head": F.substring_index("text", " ", 1), "all": F.col("text")}, {"head": 3.0, "all": 1.0}
    both = SR.bm25(docs(spark), "doc_id", fields, needs(spark), weights=weights)
    assert "keys=[qid, doc, term" not in plan(both) and "keys=[doc, term" in plan(both)
    want = {}
    qterms = SR.query_terms(needs(spark))
    for name, col in fields.items():
        ts = SR.bm25_term_scores(docs(spark), "doc_id", {name: col}, qterms, weights)
        for r in ts.collect():
            key = (r.qid, r.doc, r.term)
            want[key] = max(want.get(key, 0.0), r.s)
    got = {(r.qid, r.doc): r.score for r in both.collect()}
    assert set(got) == {k[:2] for k in want}
    assert all(abs(got[k] - sum(s for x, s in want.items() if x[:2] == k)) < 1e-9 for k in got)


def test_terms_are_counted_without_a_second_pattern(spark):
    texts = ["b a b b", "", "s", "a.b’c a.b’c it's İstanbul Straße Æon øre x_1 ²½ 東京 9.5.", "the of", "É é é 'q' r..s"]
    idx = SR.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", {"text": "text"})
    assert "\\1" not in plan(idx)
    whole = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select(
        "doc_id", F.regexp_extract_all(F.replace(F.replace(F.replace(F.translate(F.lower("text"), config.FOLD_FROM, config.FOLD_TO),
            F.lit("ß"), F.lit("ss")), F.lit("æ"), F.lit("ae")), F.lit("œ"), F.lit("oe")), F.lit(config.TOKEN_PATTERN), 0).alias("tokens"),
        A.raw_tokens("text").alias("raw"), A.analyze("text").alias("terms")).collect()
    assert all(r.tokens == r.raw for r in whole)
    want = {(r.doc_id, None, len(r.terms), 1) for r in whole} | {(r.doc_id, x, len(r.terms), r.terms.count(x)) for r in whole for x in r.terms}
    assert {tuple(r) for r in idx.select("doc", "term", "dl", "tf").collect()} == want and idx.count() == len(want)
