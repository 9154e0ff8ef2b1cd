import random

import pytest
import sentencepiece

from quarry.llm import pieces
from quarry.llm.queries import vocabulary


@pytest.fixture(scope="module")
def both():
    with open(vocabulary(), "rb") as f:
        model = f.read()
    return pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)


def texts():
    rng = random.Random(0)
    some = ["th", "e", " ", "  ", "é", "ß", "x", "z", "\n", "日", "ing", "0", "##", "😀", "\t", " the", "$$", "▁", "-", "Ａ", "\0"]
    yield from ("", " ", "a", " a", "  a  b ", "a\nb\tc", "<s> </s>", " " * 5 + "x" + " " * 33 + "yy" + " " * 15, "a" * 500, "日本語のテキスト" * 50, "$" * 41)
    for _ in range(400):
        yield "".join(rng.choice(some) for _ in range(rng.randrange(1, 250)))


def test_ids_and_texts_equal_the_library(both):
    own, library = both
    for t in texts():
        ids = own.encode(t).tolist()
        assert ids == library.encode(t), t
        assert own.decode(ids) == library.decode(ids), t


def test_neighbour_check_equals_merging(both):
    own, rng = both[0], random.Random(1)
    some = list(own.ids)
    for _ in range(3000):
        a, b = rng.choice(some), rng.choice(some)
        assert own._agrees(own.ids[a] * len(own.piece) + own.ids[b]) == (own._merged(a + b)[0] == [a, b])


def test_round_trip_in_spark(docs_of, prose):
    rows = [(1, prose(1, 20_000)), (2, None), (3, ""), (4, "a▁b"), (5, "é\n x"), (5, "é\n x"), (None, "q")]
    coded = pieces.encode(docs_of(rows), vocabulary())
    got = {(r.doc_id, r.text): (r.n_tokens, len(r.ids), r.round_trip) for r in coded.select("_row.doc_id", "_row.text", "n_tokens", "ids", "round_trip").collect()}
    assert all(n == k and trip == (t != "a▁b") for (_, t), (n, k, trip) in got.items())
    assert got[2, None] == (0, 0, True)
    back = pieces.decode(coded.selectExpr("_row.text as original", "ids"), vocabulary()).selectExpr("_row.original", "text").collect()
    assert len(back) == len(rows) and all(r.text == (r.original or "").replace("▁", " ") for r in back)
    assert pieces.encode(docs_of([]), vocabulary()).collect() == []
