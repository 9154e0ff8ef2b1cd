import collections
import math
import os
import re
import tempfile
import zlib

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import ngrams
from quarry.llm.eliasfano import EliasFano, Trie


def test_sequences_equal_search_in_arrays():
    rng = np.random.default_rng(0)
    for n, u in ((0, 10), (1, 1), (5, 5), (1000, 1 << 40), (1000, 1010), (3000, 100)):
        v = np.sort(rng.integers(0, u, n))
        e = EliasFano.encode(v, u)
        assert (e.access(np.arange(n)) == v).all() if n else e.n == 0
        x = rng.integers(0, u + 5, 300)
        if n:
            assert (e.successor(x) == np.searchsorted(v, x)).all()
            begin = rng.integers(0, n, 300)
            end = np.minimum(n, begin + rng.integers(0, 50, 300))
            assert (e.successor(x, begin, end) == np.clip(np.searchsorted(v, x), begin, end)).all()
        assert (e.find(x) >= 0).tolist() == np.isin(x, v).tolist()


def test_trie_from_file():
    rng = np.random.default_rng(1)
    pairs = np.unique(np.stack([rng.integers(0, 50, 2000) * 977, rng.integers(0, 400, 2000)], 1).astype(np.uint64), axis=0)
    value = rng.random(len(pairs))
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "t")
        Trie.build(pairs[:, 0], pairs[:, 1], value).save(path)
        trie = Trie.load(path)
        assert np.abs(trie.lookup(pairs[:, 0], pairs[:, 1]) - value).max() < 1 / 255
        assert np.isnan(trie.lookup(pairs[:, 0] + np.uint64(1), pairs[:, 1])).all()


def brute(rows):
    token = {k: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None] for k, (_, t) in enumerate(rows)}
    train = [k for k, (i, _) in enumerate(rows) if zlib.crc32(str(i).encode()) % 7 != 2]
    uni, ctx, two = collections.Counter(), collections.Counter(), collections.Counter()
    for k in train:
        uni.update(token[k])
        for c, w in zip([0] + token[k][:-1], token[k]):
            ctx[c] += 1
            two[c, w] += 1
    followers, total = collections.Counter(c for c, _ in two), sum(uni.values())
    unigram = lambda w: math.log10((uni[w] + 1) / (total + len(uni) + 1))
    out = []
    for k, (i, _) in enumerate(rows):
        score = 0.0
        for c, w in zip([0] + token[k][:-1], token[k]):
            if two[c, w]:
                score += math.log10((two[c, w] - ngrams.DISCOUNT) / ctx[c])
            else:
                score += (math.log10(ngrams.DISCOUNT * followers[c] / ctx[c]) if ctx[c] else 0) + unigram(w)
        out.append((i, k not in train, len(token[k]), sum(uni[w] > 0 for w in token[k]), total, sum(map(unigram, token[k])), score))
    return sorted(out)


def test_scores_equal_brute_force(docs_of, prose):
    rows = [(i, prose(i % 25, 40 + i)) for i in range(60)] + [(60, None), (61, ""), (62, "A a  A\ta"), (63, prose(3, 9000)), (64, "日本 été")]
    rows += [rows[5], rows[5]]
    got = ngrams.score(docs_of(rows), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    got = sorted(tuple(r) for r in got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect())
    want = brute(rows)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert abs(a[5] - b[5]) < 1e-6 * (1 + abs(b[5]))
        assert abs(a[6] - b[6]) < 0.01 * a[2]  # probabilities are quantised
    assert ngrams.score(docs_of([]), F.lit(True)).collect() == []
    assert ngrams.score(docs_of([(1, "a b")]), F.lit(False)).select("n_known", "score").first() == (0, 0.0)


def brute_order(rows, order):
    """Scores of an order by its definition, over begins, words and the end."""
    token = [[0] * (order - 1) + re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None] for _, t in rows]
    train = [k for k, (i, _) in enumerate(rows) if zlib.crc32(str(i).encode()) % 7 != 2]
    grams, contexts = collections.Counter(), collections.Counter()
    for k in train:
        for j in range(order - 1, len(token[k])):
            for o in range(order):
                grams[tuple(token[k][j - o:j + 1])] += 1
                contexts[tuple(token[k][j - o:j])] += 1
    followers = collections.Counter(g[:-1] for g in grams)
    kinds = followers[()]

    def log(g):
        if len(g) == 1:
            return math.log10((grams[g] + 1) / (contexts[()] + kinds + 1))
        if grams[g]:
            return math.log10((grams[g] - ngrams.DISCOUNT) / contexts[g[:-1]])
        return (math.log10(ngrams.DISCOUNT * followers[g[:-1]] / contexts[g[:-1]]) if contexts[g[:-1]] else 0) + log(g[1:])

    return sorted((i, sum(log(tuple(token[k][j - order + 1:j + 1])) for j in range(order - 1, len(token[k])))) for k, (i, _) in enumerate(rows))


def test_orders_and_hot_grams_equal_brute_force(docs_of, prose, monkeypatch):
    """With few and with many grams broadcast, and hot ones only held out."""
    rows = [(i, prose(i % 25, 40 + i)) for i in range(40)] + [(100 + i, None) for i in range(30)] + [(200 + i, "of the " * 90) for i in range(9)]
    held = [i for i in range(300, 400) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows += [(i, "in a " * 200 + prose(i, 20)) for i in held] + [(62, "A a  A\ta"), (64, "日本 été")]
    for order, share in ((3, 1000), (3, 20), (2, 20), (4, 100)):
        monkeypatch.setattr(ngrams, "SHARE", share)
        monkeypatch.setattr(ngrams, "LOCAL", 4 * share)
        got = ngrams.score(docs_of(rows), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, order=order)
        got = sorted((r.doc_id, r.n_tokens, r.score) for r in got.select("doc_id", "n_tokens", "score").collect())
        for a, b in zip(got, brute_order(rows, order), strict=True):
            assert a[0] == b[0] and abs(a[2] - b[1]) < 0.01 * a[1] + 0.02, (order, share, a, b)


def test_hot_grams_do_not_reach_the_shards(docs_of):
    """What is packed for the shards does not grow with one pair."""
    from types import SimpleNamespace

    import pyarrow as pa

    h = ngrams._prints([np.array([ngrams.END]), np.array([ngrams.BEGIN])])
    hot = {2: ngrams.Hot(ngrams._gram_id(h), np.array([5]), h.T), -1: ngrams.Hot(ngrams._context_id(h[1:]), np.array([5]), h[1:].T)}
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array([""] * 499 + ["x x x x x x x"]), pa.array([True] * 500)], ["k", "t", "r"])
    out = [r for x in ngrams._packer(2, 12, SimpleNamespace(value=hot))(iter([batch])) for r in x.to_pylist()]
    assert sum(len(r["keys"]) // 8 for r in out) <= 3  # (begin, x), (x, x) once and (x, end)
    assert sum(ngrams._unsmall(r["times"]).sum() for r in out) == 8


def test_query_scores_trigrams(spark, docs_of, prose, monkeypatch):
    from quarry.llm import queries

    rows = [(i, prose(i % 7, 30 + i)) for i in range(30)]
    monkeypatch.setattr(queries, "table", lambda *_: docs_of(rows))
    got = sorted((r.doc_id, r.n_tokens, r.score) for r in queries.QUERIES["op3_ngram_scores"](spark, "").collect())
    for a, b in zip(got, brute_order(rows, 3), strict=True):
        assert a[0] == b[0] and abs(a[2] - b[1]) < 0.01 * a[1] + 0.02


def test_packed_grams_are_read_back_and_small():
    rng = np.random.default_rng(2)
    for n, u in ((0, 1), (1, 1), (5, 300), (3000, 70_000), (10, 1 << 40)):
        x = rng.integers(0, u, n)
        assert (ngrams._unsmall(ngrams._small(x)) == x).all() and len(ngrams._unsmall(ngrams._small(x))) == n
    for k in (2, 3):
        words = np.unique(rng.integers(0, 1 << 40, 20_000).astype(np.uint64))
        grams = rng.integers(0, len(words), (k, 30_000))
        for g in (grams, grams[:, np.lexsort((grams[0], grams[1]))]):  # in any order, and sorted by the context's word
            packed = ngrams._spelt(words, g)
            assert (ngrams._unspelt(*packed, k) == words[g]).all()
        assert len(packed[0]) < 4.2 * len(words)  # five bytes a word before
        assert len(packed[1]) < (2 * k - 1.5) * 30_000  # two bytes a number before
