"""Terms counted over the characters of many texts at once (Arrow batches).

The tokens are those of ``functions.analyze.raw_tokens``: texts of ``SIMPLE``
characters only (Latin letters, general punctuation; their lower case, fold and
class are the same wherever they are looked up) are cut here, all others come
as token lists made by Spark. What follows from a token - stopword, stem,
n-grams - is found once per distinct token of a block.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .. import config

# Characters whose tokens are found here: those up to U+017F but I with a dot
# (its lower case is two characters), and signs that are no letter or number.
_RANGES = ((0, 0x12F), (0x131, 0x17F), (0x2000, 0x206F), (0x20A0, 0x20AC))
SIMPLE = "\\A[" + "".join(rf"\u{a:04X}-\u{b:04X}" for a, b in _RANGES) + "]*+\\z"

# Characters of one block of texts; its arrays take about 100 bytes each.
BLOCK_CHARS = 1_000_000


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By character: what it folds to, a second character of that or 0; by
    folded character: whether it is a word's, whether it joins two words."""
    size = _RANGES[-1][1] + 1
    first, second = np.zeros(size, np.uint16), np.zeros(size, np.uint16)
    word, joint = np.zeros(size, bool), np.zeros(size, bool)
    single, double = dict(zip(config.FOLD_FROM, config.FOLD_TO, strict=True)), dict(config.MULTI_FOLDS)
    for a, b in _RANGES:
        for code in range(a, b + 1):
            low = chr(code).lower()
            low = single.get(low, low)
            low = double.get(low, low)
            first[code], second[code] = ord(low[0]), ord(low[1]) if len(low) > 1 else 0
            word[code] = code == ord("_") or unicodedata.category(chr(code))[0] in "LN"
            joint[code] = chr(code) in "'’."
    return first, second, word, joint


_FIRST, _SECOND, _WORD, _JOINT = _tables()


def tokens(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """(tokens, place of each one's text) of texts of simple characters."""
    chars = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    codes, more = _FIRST[chars], _SECOND[chars]
    if more.any():
        end = np.cumsum(1 + (more > 0))
        codes = np.repeat(codes, 1 + (more > 0))
        codes[end[more > 0] - 1] = more[more > 0]
        starts = np.concatenate([[0], end])[starts]
    word = _WORD[codes]
    held = np.zeros(len(codes) + 2, bool)
    held[1:-1] = word
    held[2:-2] |= _JOINT[codes[1:-1]] & word[:-2] & word[2:] if len(codes) > 2 else False
    edges = np.flatnonzero(held[1:] != held[:-1])
    begin, end = edges[::2], edges[1::2]
    kept = codes[held[1:-1]]
    places = np.concatenate([[0], np.cumsum(end - begin)])
    if kept.size and kept.max() >= 0x80:
        places = np.concatenate([[0], np.cumsum(1 + (kept >= 0x80) + (kept >= 0x800))])[places]
        data = kept.astype("<u2").tobytes().decode("utf-16-le").encode()
    else:
        data = kept.astype(np.uint8).tobytes()
    found = pa.StringArray.from_buffers(len(begin), pa.py_buffer(places.astype(np.int32).tobytes()), pa.py_buffer(data))
    return found, np.searchsorted(starts, begin, "right") - 1


# What the distinct tokens of a block give: (terms, how many of them each token has).
Analyzer = Callable[[pa.StringArray], tuple[pa.StringArray, np.ndarray]]


def _kept(found: pa.StringArray, stopwords: Iterable[str] | None) -> np.ndarray:
    stop = config.ANALYZER_STOPWORDS if stopwords is None else tuple(stopwords)
    return ~pc.is_in(found, pa.array(stop, pa.string())).to_numpy(zero_copy_only=False)


def stems(stopwords: Iterable[str] | None = None) -> Analyzer:
    """``functions.analyze.analyze``."""
    def run(found: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        kept = _kept(found, stopwords)
        found = found.filter(pa.array(kept))
        less, y = pc.utf8_slice_codeunits(found, 0, -1), pc.binary_join_element_wise(pc.utf8_slice_codeunits(found, 0, -3), "y", "")
        ends = lambda end, *but: functools.reduce(pc.and_not, (pc.ends_with(found, x) for x in but), pc.ends_with(found, end))
        cases = [ends("ies", "eies", "aies"), ends("es", "aes", "ees", "oes"), ends("s", "us", "ss")]
        return pc.case_when(pc.make_struct(*cases), y, less, less, found), kept.astype(np.int64)

    return run


def grams(n: int, stopwords: Iterable[str] | None = None) -> Analyzer:
    """The n-grams inside every token that is no stopword."""
    def run(found: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        kept = _kept(found, stopwords)
        plain = pc.string_is_ascii(found).to_numpy(zero_copy_only=False)
        sizes = pc.utf8_length(found).to_numpy().astype(np.int64)
        many = np.where(kept, np.maximum(sizes - n + 1, 0), 0)
        if plain.all():
            at = np.frombuffer(found.buffers()[1], np.int32)[found.offset:found.offset + len(found)]
            data = np.frombuffer(found.buffers()[2] or b"", np.uint8)
            first = np.repeat(at - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            out = data[first[:, None] + np.arange(n)].tobytes()
            places = np.arange(len(first) + 1, dtype=np.int32) * n
            return pa.StringArray.from_buffers(len(first), pa.py_buffer(places.astype(np.int32).tobytes()), pa.py_buffer(out)), many
        some = np.flatnonzero(~plain)
        terms, _ = run(found.filter(pa.array(plain)))
        more = pa.array([t[i:i + n] for t, k in zip(found.take(pa.array(some)).to_pylist(), many[some].tolist(), strict=True) for i in range(k)], pa.string())
        # both parts are brought into the order of the tokens
        token = np.concatenate([np.repeat(np.flatnonzero(plain), many[plain]), np.repeat(some, many[some])])
        return pa.concat_arrays([terms, more]).take(pa.array(np.argsort(token, kind="stable"))), many

    return run


def as_is(found: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    return found, np.ones(len(found), np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about BLOCK_CHARS bytes of text or tokens each."""
    tokens = batch.column("tokens")
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    if tokens.null_count < len(tokens):
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(tokens.flatten()).to_numpy())])
        many = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
        sizes += np.diff(ends[np.concatenate([[0], np.cumsum(many)])])
    block = np.cumsum(sizes) // BLOCK_CHARS
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [batch.num_rows]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def _runs(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, in order, and the sum of each one's counts."""
    if not keys.size:
        return keys, counts
    bits = int(counts.max()).bit_length()
    if int(keys.max()) < 1 << (63 - bits):
        both = np.sort((keys << bits) | counts)
        keys, counts = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


def counter(analyzer: Analyzer, lists: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow from (field, doc, text, tokens, _keep), where
    a row has its text or its tokens, to ``search.term_rows``, or with
    ``lists`` to one row per text (field, doc, dl, terms, tfs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch):
                yield _counted(block, analyzer, lists)

    return run


def _found(block: pa.RecordBatch) -> tuple[pa.StringArray, np.ndarray]:
    """(tokens, row of each) of a block, each row's in the order of its text."""
    texts = block.column("text").to_pylist()
    here = [i for i, t in enumerate(texts) if t is not None]
    found, place = tokens([texts[i] for i in here])
    place = np.asarray(here, np.int64)[place]
    cut = block.column("tokens")
    if cut.null_count < len(cut):
        found = pa.concat_arrays([found, cut.flatten().cast(pa.string())])
        many = pc.fill_null(pc.list_value_length(cut), 0).to_numpy()
        place = np.concatenate([place, np.repeat(np.arange(len(cut)), many)])
    return found, place


def placer(analyzer: Analyzer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow from what ``counter`` reads to
    ``search.doc_terms``: (field, doc, terms), the terms in place and null for
    a token without one. ``analyzer`` gives at most one term a token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch):
                found, place = _found(block)
                coded = found.dictionary_encode()
                terms, gives = analyzer(coded.dictionary)
                terms = terms.take(pa.array(np.cumsum(gives) - 1, mask=gives == 0)).take(coded.indices)
                if block.column("tokens").null_count < block.num_rows:
                    order = np.argsort(place, kind="stable")
                    terms, place = terms.take(pa.array(order)), place[order]
                ends = pa.array(np.searchsorted(place, np.arange(block.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_pydict({"field": block.column("field"), "doc": block.column("doc"), "terms": pa.ListArray.from_arrays(ends, terms)})

    return run


def _counted(block: pa.RecordBatch, analyzer: Analyzer, lists: bool) -> pa.RecordBatch:
    n = block.num_rows
    found, place = _found(block)
    coded = found.dictionary_encode()
    terms, gives = analyzer(coded.dictionary)
    terms = terms.dictionary_encode()
    of, begin = terms.indices.to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(gives)])
    words = max(len(gives), 1)
    keys, counts = _runs(place * words + coded.indices.to_numpy(), np.ones(len(place), np.int64))
    word = keys % words
    many = gives[word]
    nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    term, row, counts = of[np.repeat(begin[word], many) + nth], np.repeat(keys // words, many), np.repeat(counts, many)
    lengths = np.bincount(row, counts, n).astype(np.int32)
    kinds = len(terms.dictionary) + 1
    if lists:
        keys, counts = _runs(row * kinds + term, counts)
        ends = pa.array(np.searchsorted(keys // kinds, np.arange(n + 1)).astype(np.int32))
        columns = {
            "field": block.column("field"), "doc": block.column("doc"), "dl": pa.array(lengths),
            "terms": pa.ListArray.from_arrays(ends, terms.dictionary.take(pa.array(keys % kinds))),
            "tfs": pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))),
        }
        return pa.RecordBatch.from_pydict(columns)
    # the length row of each text stands before its terms, as term 0
    keys, counts = _runs(np.concatenate([np.arange(n) * kinds, row * kinds + term + 1]), np.concatenate([np.ones(n, np.int64), counts]))
    row, term = keys // kinds, keys % kinds
    at = pa.array(row)
    columns = {
        "field": block.column("field").take(at), "term": terms.dictionary.take(pa.array(term - 1, mask=term == 0)),
        "doc": block.column("doc").take(at), "dl": pa.array(lengths[row]), "_keep": block.column("_keep").take(at), "tf": pa.array(counts),
    }
    return pa.RecordBatch.from_pydict(columns)
