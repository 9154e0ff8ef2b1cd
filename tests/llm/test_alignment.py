import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quarry.llm import alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def contents():
    return [open(p, "rb").read() for p in FILES]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def odd_texts():
    rng = random.Random(3)
    some = ["the ", "e", " ", "  ", "é", "ß", "\n", "日本", "ing", "0", "12", "##", "😀", "\t", "▁", "-", "'s", "<|endoftext|>", "</s>", "<0x41>", "\0", " ", "x" * 30]
    yield from ("", " ", "a", "<|endoftext|>", "<s>x</s>", "a▁b", "hello hello hello", "é" * 200, "ab" * 700, "\n" * 99, "日本語" * 40)
    for _ in range(60):
        yield "".join(rng.choice(some) for _ in range(rng.randrange(1, 120)))


def plain(texts, both):
    """The definition, pair by pair."""
    a_lib, b_lib = both
    byte, shown = {}, alignment._byte_of()
    for t, i in a_lib.get_vocab().items():
        byte[i] = bytes(shown[c] for c in t) if i != 50256 else b""

    def b_bytes(i):
        p = b_lib.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()

    docs, held = [], Counter()
    for t in texts:
        a, b = (a_lib.encode(" " + t, add_special_tokens=False).ids, b_lib.encode(t)) if t else ([], [])
        ta, tb, spelt = [byte[i] for i in a], [b_bytes(i) for i in b], (" " + (t or "")).encode()
        if not t or b"".join(ta) != spelt or b"".join(tb) != spelt:
            docs.append(([], []))
            continue
        ends = lambda s: np.cumsum([len(x) for x in s]).tolist()
        ea, eb = ends(ta), ends(tb)
        groups, i, j = [], 0, 0
        at_a, at_b = {e: p for p, e in enumerate(ea, 1)}, {e: p for p, e in enumerate(eb, 1)}
        for e in sorted(set(ea) & set(eb)):
            p, q = at_a[e], at_b[e]
            groups.append((a[i:p], b[j:q]))
            i, j = p, q
        linked = [(x, y) for g in groups for x in g[0] for y in g[1]]
        held.update(set(linked))
        docs.append((groups, linked))
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for groups, linked in docs:
        spelled = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(linked), sum(held[p] == best[p[0]] for p in linked),
                    sum(held[p] for p in linked), hashlib.sha256(spelled.encode()).hexdigest() if groups else ""))
    return out


@pytest.mark.parametrize("part, bucket", [(8_000_000, 1 << 18), (4000, 1000)])
def test_equals_the_definition(docs_of, prose, both, monkeypatch, part, bucket):
    monkeypatch.setattr(alignment, "PART_PAIRS", part)
    monkeypatch.setattr(alignment, "BUCKET_PAIRS", bucket)
    texts = [*odd_texts(), None, *(prose(i, 150) for i in range(8)), prose(1, 150), prose(9, 8000)]
    got = alignment.link(docs_of([(i if i != 5 else None, t) for i, t in enumerate(texts)]), *FILES).collect()
    cols = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(t or "", *row) for t, row in zip(texts, plain(texts, both), strict=True)]
    have = sorted((r._row.text or "", *(r[c] for c in cols)) for r in got)
    assert [x[:30] for x in map(repr, have)] == [x[:30] for x in map(repr, sorted(want))]
    assert [x[1:] for x in have] == [x[1:] for x in sorted(want)]


def test_no_rows(docs_of):
    assert alignment.link(docs_of([]), *FILES).collect() == []
    assert [r.n_a for r in alignment.link(docs_of([(1, None), (2, "")]), *FILES).collect()] == [0, 0]


def test_ranked_encoder_equals_the_library(both):
    own = alignment.Tokenizers(*contents())
    assert own._ranked is not None and own._a.__name__ == "encode_ordinary"
    library = own._library(contents()[0])
    for t in odd_texts():
        assert own._a(" " + t) == both[0].encode(" " + t, add_special_tokens=False).ids
        assert library(" " + t) == own._a(" " + t)


def test_hash_is_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 32, 50_000))
    rows = []
    for bucket in range(7):
        own = keys[keys % 7 == bucket]
        sizes, words, order = alignment.build_hash(own)
        rows.append((bucket, sizes, words, order, order * 3))
    table = alignment.PairTable(7, rows)
    at = table.find(keys)
    assert sorted(at.tolist()) == list(range(len(keys))) and (table.counts[at] == keys * 3).all()
    assert (table.find(np.setdiff1d(rng.integers(0, 1 << 32, 9000), keys)) == -1).all()
    with pytest.raises(ValueError):
        alignment.build_hash(np.array([5, 5]))
    assert len(alignment.PairTable(7, []).find(keys)) == len(keys)


def test_large_groups_are_reduced(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 5, 60), rng.integers(0, 4, 90)
    x = alignment.align(a, b, np.full(5, 3), np.full(4, 2))

    def total():
        out = Counter()
        for g, p, n in alignment.links(x, 4):
            for row in zip(g.tolist(), p.tolist(), n.tolist(), strict=True):
                out[row[:2]] += row[2]
        return out

    want = total()
    assert sum(want.values()) == int((x.n_a * x.n_b).sum())
    monkeypatch.setattr(alignment, "LARGE_GROUP", 5)
    monkeypatch.setattr(alignment, "LINKS", 3)
    assert total() == want
