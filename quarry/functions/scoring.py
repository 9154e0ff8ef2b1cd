"""Scores of many needs over blocks of documents (Arrow batches).

What a document's postings are worth stands in a table of terms x documents;
sums over the terms of a word and over the words of a need are sums of its
rows, made for all documents of the block at once. Every (need, document) that
shares a term gets a row, as a join and an aggregate would give.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Numbers in a block's largest table (8 bytes each), and rows that are read
# before blocks are made of them.
BLOCK_CELLS = 1_000_000
BLOCK_ROWS = 50_000

# Scores that differ by less may be equal once they are rounded for a ranking.
CLOSE = 2e-6


class Groups:
    """Sums of rows: member i of the result is the sum of the rows ``of[i]``,
    each as often as it is named there, 0 for a member without. The n-th rows
    of all members that have so many are added at once."""

    def __init__(self, of: Sequence[Sequence[int]]):
        self.of, self.size = of, len(of)
        self.order = np.array(sorted(range(len(of)), key=lambda i: -len(of[i])), np.int64)
        self.nth = [np.array([of[i][n] for i in self.order[:many]], np.int64) for n, many in enumerate(self._many([len(x) for x in of]))]

    @staticmethod
    def _many(lengths: Sequence[int]) -> list[int]:
        """By n: how many members have more than n rows."""
        at_least = np.cumsum(np.bincount(np.array(lengths, np.int64), minlength=1)[::-1])[::-1]
        return at_least[1:].tolist()

    def sum(self, table: np.ndarray) -> np.ndarray:
        sums = np.zeros((self.size, table.shape[1]), table.dtype)
        for rows in self.nth:
            sums[:len(rows)] += table[rows]
        out = np.empty_like(sums)
        out[self.order] = sums
        return out


def same_as_before(col: pa.Array) -> np.ndarray:
    """For every row but the first: whether it equals the row before; null
    equals null."""
    a, b = col.slice(1), col.slice(0, len(col) - 1)
    null = pc.is_null(a).to_numpy(zero_copy_only=False), pc.is_null(b).to_numpy(zero_copy_only=False)
    if pa.types.is_struct(col.type):
        same = np.ones(len(a), bool)
        for i in range(col.type.num_fields):
            same &= same_as_before(pc.struct_field(col, [i]))
    else:
        same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
    return (null[0] & null[1]) | (same & ~null[0] & ~null[1])


def _blocks(batches: Iterator[pa.RecordBatch], docs: int, least: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, the first of each document) of at most ``docs`` documents, cut
    from at least so many rows; the rows of a document follow each other."""
    kept, rows = [], 0
    for batch in batches:
        kept, rows = [*kept, batch], rows + batch.num_rows
        if rows < least:
            continue
        batch = pa.concat_batches(kept)
        first = np.concatenate([[0], np.flatnonzero(~same_as_before(batch.column("doc"))) + 1])
        last = int(first[-1])  # the last document may go on in the next batch
        yield from _cut(batch, first[:-1], last, docs)
        kept, rows = [batch.slice(last)], 0
    if kept and (batch := pa.concat_batches(kept)).num_rows:
        first = np.concatenate([[0], np.flatnonzero(~same_as_before(batch.column("doc"))) + 1])
        yield from _cut(batch, first, batch.num_rows, docs)


def _cut(batch: pa.RecordBatch, first: np.ndarray, end: int, docs: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for a in range(0, len(first), docs):
        till = int(first[a + docs]) if a + docs < len(first) else end
        yield batch.slice(int(first[a]), till - int(first[a])), first[a:a + docs] - first[a]


# The postings of a block: (row of each, id, worth).
Postings = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


def one_by_one(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (doc, id, worth) of a posting each."""
    return np.arange(block.num_rows), block.column("id").to_numpy().astype(np.int64), block.column("worth").to_numpy()


def in_lists(idf: np.ndarray, avgdl: np.ndarray, k1: float, b: float) -> Postings:
    """Rows (doc, dl, ids, tfs) of a text each; idf and mean length by id."""
    def run(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, tf = block.column("ids").flatten().to_numpy(), block.column("tfs").flatten().to_numpy().astype(np.float64)
        row = np.repeat(np.arange(block.num_rows), pc.list_value_length(block.column("ids")).to_numpy())
        dl = block.column("dl").to_numpy().astype(np.float64)[row]
        return row, ids.astype(np.int64), idf[ids] * tf / (tf + k1 * ((1.0 - b) + b * dl / avgdl[ids]))

    return run


def matcher(asked: dict[str, tuple[list[str], list[int]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow from (field, doc, dl, terms, tfs) to the same
    texts with the asked terms only, as (field, doc, dl, ids, tfs). ``asked``
    has terms and their ids by field."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = {f: (pa.array(terms, pa.string()), np.array(ids, np.int32)) for f, (terms, ids) in asked.items()}
        for batch in batches:
            for field in pc.unique(batch.column("field")).to_pylist():
                part = batch.filter(pc.equal(batch.column("field"), field))
                terms, numbers = sets.get(field, (pa.array([], pa.string()), np.zeros(0, np.int32)))
                at = pc.index_in(part.column("terms").flatten(), value_set=terms)
                found = pc.is_valid(at).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(part.column("terms")).to_numpy())])
                ends = pa.array(np.concatenate([[0], np.cumsum(found)])[ends].astype(np.int32))
                ids, tfs = numbers[at.drop_null().to_numpy()], part.column("tfs").flatten().to_numpy()[found]
                yield pa.RecordBatch.from_pydict({
                    "field": part.column("field"), "doc": part.column("doc"), "dl": part.column("dl"),
                    "ids": pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())), "tfs": pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32())),
                })

    return run


def id_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n) of each batch's ids."""
    for batch in batches:
        n = np.bincount(batch.column("ids").flatten().to_numpy())
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"id": pa.array(some.astype(np.int32)), "n": pa.array(n[some].astype(np.int64))})


class Best:
    """Tells the rows of a task that may be among the ``k`` best of their
    need: all but those well below the k-th best that the task has seen."""

    def __init__(self, needs: int, k: int):
        self.top = np.full((k, needs), -np.inf)

    def among(self, found: np.ndarray, score: np.ndarray) -> np.ndarray:
        k = len(self.top)
        seen = np.concatenate([self.top, np.where(found, score, -np.inf).T])
        self.top = np.partition(seen, len(seen) - k, axis=0)[len(seen) - k:]
        return found & (score >= self.top.min(axis=0)[:, None] - CLOSE)


def scorer(qids: pa.Array, needs: Groups, n_ids: int, words: Sequence[tuple[Groups, float]] | None = None,
           min_match: int = 1, best: int | None = None, postings: Postings = one_by_one) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow from postings, a document's rows one after the
    other, to (qid, doc, score, matched).

    Without ``words``, needs are sums of ids and ``matched`` counts the
    postings. With ``words``, they are sums of words, a word is worth the most
    that one of the (sum of ids, weight) gives it, and ``matched`` counts
    words; worths are then above 0. Rows match at least ``min_match``, and with
    ``best`` those are left out that cannot be among so many of a need."""
    once = Groups([[*dict.fromkeys(x)] for x in needs.of])  # a term counts once, however often a need has it
    per_doc = max(n_ids, needs.size, words[0][0].size if words else 0, 1)
    docs = max(1, min(512, BLOCK_CELLS // per_doc))
    least = BLOCK_ROWS if postings is one_by_one else 2 * docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = Best(needs.size, best) if best else None
        for block, first in _blocks(batches, docs, least):
            doc, n = block.column("doc").take(pa.array(first)), len(first)
            row, ids, worth = postings(block)
            cell = ids * n + np.repeat(np.arange(n), np.diff(first, append=block.num_rows))[row]
            table = np.bincount(cell, worth, n_ids * n).reshape(n_ids, n)
            if words is None:
                held = np.bincount(cell, minlength=n_ids * n).astype(np.int32).reshape(n_ids, n)
            else:
                most = None
                for group, weight in words:
                    got = group.sum(table)
                    got = np.where(got > 0, got * weight, -np.inf)
                    most = got if most is None else np.maximum(most, got)
                held = (most > -np.inf).astype(np.int32)
                table = np.where(held, most, 0.0)
            matched, score = once.sum(held), needs.sum(table)
            found = matched >= max(min_match, 1)
            if ranked is not None:
                found = ranked.among(found, score)
            at, need = np.nonzero(found.T)
            columns = {"qid": qids.take(pa.array(need)), "doc": doc.take(pa.array(at)), "score": pa.array(score[need, at]), "matched": pa.array(matched[need, at].astype(np.int64))}
            yield pa.RecordBatch.from_pydict(columns)

    return run
