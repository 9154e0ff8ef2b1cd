"""Language-model scores from sharded Elias-Fano n-gram tries (Pibiri and
Venturini, SIGIR 2017), one level of contexts for each order.

The model is absolute discounting with back-off over tokens (lower-cased
words, then one end per text; order - 1 begins stand before a text):

    p(w | c) = (n(c, w) - D) / n(c)              if c is followed by w in training
    p(w | c) = D * N(c) / n(c) * p(w | c')       if c is known, N(c) its distinct followers
    p(w | c) = p(w | c')                         otherwise, c' without c's first token
    p(w) = (n(w) + 1) / (N + V + 1)

No model is held whole:

* grams are dealt by the hash of their context over shards of about
  ``SHARD_TOKENS`` tokens, as the distinct grams of a block with their training
  count and the texts that have them. Each shard builds a trie of its training
  grams in a memory-mapped file and looks its grams up by successor search;
* the shards of one order send those of the next lower one its training counts
  (sums over the first token) and the grams that they do not hold;
* grams and contexts with more than one in ``SHARE`` of all tokens, at most so
  many for each length, are counted first and broadcast: such grams are scored
  where the text is read, and grams of such contexts are dealt by the hash of
  context and word, so no shard grows with one of them;
* counts of words form a table. The words with more than 1 in ``FREQUENT``
  tokens, at most so many, are broadcast; the others are joined by word.

Grams are identified by 40-bit fingerprints of their words and contexts (a
context of several words by a hash of theirs), counts of words by 64-bit hashes.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .eliasfano import Trie
from .spread import stage

DISCOUNT = 0.8
SHARD_TOKENS = 2_500_000
FREQUENT = 200_000
SHARE = 1000
LOCAL = 4 * SHARE  # a block reports what has more than one in so many of its tokens
PACK_BYTES = 8_000_000  # text of one row of packed pairs
COUNT_BYTES = 3_000_000  # text of one block that is counted

END, BEGIN = np.uint64(0x0123456789ABCDEF), np.uint64(0x0FEDCBA987654321)
_FP = np.uint64(24)  # a fingerprint is the top 40 bits of a hash


def _sequence(b: tokens.Block, order: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """Every token of a block with the order - 1 tokens before it, the nearest
    first, and its text's index."""
    words, own = tokens.word_hashes(b), tokens.owners(b.bounds)
    n, texts = len(words), len(b.bounds) - 1
    token = np.full(n + texts, END)
    token[np.arange(n) + own] = words
    own = np.repeat(np.arange(texts), np.diff(b.bounds) + 1)
    place = np.arange(n + texts) - (b.bounds[:-1] + np.arange(texts))[own]
    rows = [token]
    for k in range(1, order):
        back, far = np.full(n + texts, BEGIN), np.flatnonzero(place >= k)
        back[far] = token[far - k]
        rows.append(back)
    return rows, own


_K = np.uint64(0x9E3779B97F4A7C15)


def _prints(rows: list[np.ndarray]) -> np.ndarray:
    return np.stack(rows) >> _FP


def _context(g: np.ndarray) -> np.ndarray:
    """40-bit fingerprints of contexts given by those of their words."""
    h = g[0]
    for x in g[1:]:
        h = tokens.mix(h * _K + x) >> _FP
    return h


def _context_id(g: np.ndarray) -> np.ndarray:
    return tokens.mix(_context(g) * _K ^ np.uint64(len(g)))


def _gram_id(g: np.ndarray) -> np.ndarray:
    return tokens.mix(_context_id(g[1:]) + g[0] * _K)


def _find(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Position of each x in the sorted ids, or -1."""
    if not len(ids):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(ids, x), len(ids) - 1)
    return np.where(ids[at] == x, at, -1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _kinds(g: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, ids, fingerprints) of the grams (kind k for k words) and of the
    contexts (kind -k) of tokens, from two words and one word on."""
    for k in range(2, len(g) + 1):
        yield k, _gram_id(g[:k]), g[:k]
        yield 1 - k, _context_id(g[1:k]), g[1:k]


_COUNTS = "kind int, word long, n long, gram binary"


def _counts(order: int):
    """Rows: kind 0, all tokens; 1, training words; others, what has more than
    one in LOCAL of its block's tokens."""
    def row(kind, word, n, gram=None):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), _signed(word), pa.array(np.asarray(n, np.int64)),
                                           pa.array(gram or [None] * len(n), pa.binary())], ["kind", "word", "n", "gram"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            training = batch.column(1).to_numpy(zero_copy_only=False)
            for b in tokens.blocks(batch.column(0), COUNT_BYTES):
                rows, own = _sequence(b, order)
                yield row(0, np.zeros(1, np.uint64), [len(own)])
                yield row(1, *np.unique(rows[0][training[b.first + own]], return_counts=True))
                for kind, ids, g in _kinds(_prints(rows)):
                    word, n = np.unique(ids, return_counts=True)
                    word, n = word[n * LOCAL > len(own)], n[n * LOCAL > len(own)]
                    at, first = _find(word, ids), np.zeros(len(word), np.int64)
                    first[at[at >= 0]] = np.flatnonzero(at >= 0)
                    yield row(kind, word, n, [x.tobytes() for x in np.ascontiguousarray(g[:, first].T)])

    return run


class Hot(NamedTuple):
    """What is broadcast of one kind: sorted ids, training counts, words."""

    ids: np.ndarray
    n: np.ndarray
    words: np.ndarray


def _exact(order: int, shared):
    """(kind, word, n, n_train) of the broadcast ids, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        sums = {k: np.zeros((2, len(h.ids)), np.int64) for k, h in hot.items()}
        for batch in batches:
            training = batch.column(1).to_numpy(zero_copy_only=False)
            for b in tokens.blocks(batch.column(0)):
                rows, own = _sequence(b, order)
                train = training[b.first + own]
                for kind, ids, _ in _kinds(_prints(rows)):
                    at = _find(hot[kind].ids, ids)
                    for i, mine in enumerate((at >= 0, (at >= 0) & train)):
                        sums[kind][i] += np.bincount(at[mine], minlength=len(hot[kind].ids))
        for kind, (n, n_train) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), _signed(hot[kind].ids), pa.array(n), pa.array(n_train)], ["kind", "word", "n", "n_train"])

    return run


def _hot(rows: DataFrame, counts: DataFrame, total: int, order: int) -> dict[int, Hot]:
    """Grams and contexts with more than one in SHARE of all tokens. As blocks
    leave out less than one in LOCAL, those found have three quarters of that."""
    some = counts.where("kind not in (0, 1)").where(F.col("n") * 4 * SHARE > 3 * total).toPandas()
    kinds = [k for i in range(2, order + 1) for k in (i, 1 - i)]

    def of(frame, kind):
        part = frame[frame["kind"] == kind]
        ids = part["word"].to_numpy(np.int64).view(np.uint64)
        words = np.frombuffer(b"".join(map(bytes, part["gram"])), np.uint64).reshape(len(part), -1 if len(part) else 1)
        at = np.argsort(ids)
        return Hot(ids[at], part["n_train" if "n_train" in part else "n"].to_numpy(np.int64)[at], words[at])

    shared = rows.sparkSession.sparkContext.broadcast({k: of(some, k) for k in kinds})
    exact = rows.select("_text", "_train").mapInArrow(_exact(order, shared), "kind int, word long, n long, n_train long")
    exact = exact.groupBy("kind", "word").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train")).where(F.col("n") * SHARE > total).toPandas()
    some = some.drop(columns="n").merge(exact, on=["kind", "word"])
    return {k: of(some, k) for k in kinds}


_ZSTD = pa.Codec("zstd", compression_level=1)


def _small(x: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes as the largest needs, after that size
    and their count: the last bytes of all, then the next ones, compressed."""
    size = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w)
    planes = np.ascontiguousarray(x.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T)
    return bytes([size]) + len(x).to_bytes(8, "little") + _ZSTD.compress(planes, asbytes=True)


def _unsmall(x: bytes) -> np.ndarray:
    size, n = x[0], int.from_bytes(x[1:9], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(_ZSTD.decompress(x[9:], n * size, asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(-1).astype(np.int64)


def _spelt(words: np.ndarray, grams: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted words and grams of their numbers. Words, and the nearest context
    words, by which grams are mostly sorted, as steps from one to the next."""
    grams = grams.astype(np.int64)
    grams[1] = np.diff(grams[1], prepend=0) % max(1, len(words))
    return _small(np.diff(words, prepend=np.uint64(0))), _small(grams.reshape(-1))


def _unspelt(words: bytes, grams: bytes, k: int) -> np.ndarray:
    w, g = np.cumsum(_unsmall(words)).astype(np.uint64), _unsmall(grams).reshape(k, -1)
    g[1] = np.cumsum(g[1]) % max(1, len(w))
    return w[g]


_BLOBS = ["keys", "words", "grams", "counts", "many", "owner", "times"]
_PACK = "shard int, " + ", ".join(f"{x} binary" for x in _BLOBS)
_OUT = "kind int, key long, word long, n long, value double, " + ", ".join(f"{x} binary" for x in _BLOBS)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _packed(g: np.ndarray, owner: np.ndarray, times: np.ndarray, counts: np.ndarray, keys: np.ndarray, hot: dict[int, Hot], shards: int) -> Iterator[tuple]:
    """Rows of _PACK of grams with their text (-1 for none), how often it has
    them and their training count. A row's grams are numbers of its words,
    sorted from the nearest word of the context on."""
    ids, context = _gram_id(g), _context_id(g[1:])
    shard = (np.where(_find(hot[1 - len(g)].ids, context) >= 0, ids, context) % np.uint64(shards)).astype(np.int64)
    words, spelt = np.unique(g, return_inverse=True)
    spelt, bits = spelt.reshape(g.shape), max(1, len(words).bit_length())
    if bits * len(g) < 64:
        ids = np.zeros(g.shape[1], np.int64)
        for x in [*spelt[1:], spelt[0]]:
            ids = ids << bits | x
    at = np.argsort(owner, kind="stable") if len(owner) and (owner[1:] < owner[:-1]).any() else np.arange(len(owner))
    at = at[np.argsort(ids[at], kind="stable")]
    at = at[np.argsort(shard[at].astype(np.uint16 if shards < 1 << 16 else np.int64), kind="stable")]
    g, ids, owner, times, counts, shard = g[:, at], ids[at], owner[at], times[at], counts[at], shard[at]
    gram = _starts(ids, shard)
    entry = _starts(ids, shard, owner)
    counts = np.add.reduceat(counts, gram) if len(gram) else counts
    times = np.add.reduceat(times, entry) if len(entry) else times
    which = np.searchsorted(gram, entry, "right") - 1
    asked = owner[entry] >= 0
    which, owner, times = which[asked], owner[entry][asked], times[asked]
    many = np.bincount(which, minlength=len(gram))
    ends = np.concatenate(([0], np.cumsum(many)))
    cuts = _starts(shard[gram])
    for lo, hi in zip(cuts, np.append(cuts[1:], len(gram))):
        mine = slice(ends[lo], ends[hi])
        texts, who = np.unique(owner[mine], return_inverse=True)
        words, spelt = np.unique(g[:, gram[lo:hi]], return_inverse=True)
        yield (int(shard[gram[lo]]), keys[texts].tobytes(), *_spelt(words, spelt.reshape(len(g), -1)), _small(counts[lo:hi]), _small(many[lo:hi]), _small(who), _small(times[mine]))


def _packer(order: int, shards: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch in batches:
            keys, training = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for b in tokens.blocks(batch.column(1), PACK_BYTES):
                rows, own = _sequence(b, order)
                g = _prints(rows)
                at = np.flatnonzero(_find(hot[order].ids, _gram_id(g)) < 0)
                own = own[at]
                out = list(_packed(g[:, at], own, np.ones(len(at), np.int64), training[b.first + own].astype(np.int64), keys[b.first:b.first + len(b.bounds) - 1], hot, shards))
                for i in range(0, len(out), 64):
                    part = list(zip(*out[i:i + 64]))
                    yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), *(pa.array(x, pa.binary()) for x in part[1:])], ["shard", *_BLOBS])

    return run


def _shard(order: int, shards: int, shared):
    """Build the shard's trie from training grams and look all grams up. Rows:
    kind 0, a text's sum; 1, distinct followers of a broadcast context; 2, a
    text's terms of broadcast contexts and grams; 3, its unseen words; 4, what
    goes to the shards of the next lower order."""
    def run(table: pa.Table) -> pa.Table:
        hot, k = shared.value, order
        rows = {c: table.column(c).to_pylist() for c in _BLOBS}
        texts = [np.frombuffer(x, np.int64) for x in rows["keys"]]
        keys, base = np.concatenate(texts), np.cumsum([0] + [len(x) for x in texts])
        g = np.concatenate([_unspelt(w, x, k) for w, x in zip(rows["words"], rows["grams"])], axis=1)
        n, many, times = (np.concatenate([_unsmall(x) for x in rows[c]]) for c in ("counts", "many", "times"))
        owner = np.concatenate([_unsmall(x) + o for x, o in zip(rows["owner"], base)])
        del rows, texts
        context = _context(g[1:])
        at = np.lexsort((g[0], context))
        first = _starts(context[at], g[0][at])
        gram = np.empty(len(at), np.int64)
        gram[at] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
        n = np.bincount(gram, n, len(first)).astype(np.int64)
        g, c = g[:, at[first]], context[at[first]]
        asked = np.repeat(gram, many)  # the gram of each text that has one
        known = n > 0
        with tempfile.TemporaryDirectory() as folder:
            path = os.path.join(folder, "trie")
            Trie.build(c[known], g[0][known], np.log10(n[known] - DISCOUNT)).save(path)
            value = Trie.load(path).lookup(c, g[0])
        own = _starts(c)  # of each context
        which = np.repeat(np.arange(len(own)), np.diff(np.append(own, len(c))))
        ids = _context_id(g[1:, own])
        place = _find(hot[1 - k].ids, ids)
        common = place >= 0
        total, followers = np.add.reduceat(n, own), np.add.reduceat(known.astype(np.int64), own)
        if common.any():
            total[common] = hot[1 - k].n[place[common]]
        log_total = np.log10(np.maximum(total, 1))
        weight = np.where((total > 0) & ~common, np.log10(DISCOUNT * np.maximum(followers, 1)) - log_total, 0.0)
        seen = ~np.isnan(value)
        worth = np.where(seen, value - log_total[which], weight[which])
        parts = [(0, keys, None, np.zeros(len(keys), np.int64), np.bincount(owner, worth[asked] * times, len(keys)).astype(float))]
        parts.append((1, None, ids[common], followers[common], None))

        def some(kind, chosen, what):
            """Rows of a text and what it asks for, added up."""
            at = chosen[np.lexsort((what[asked[chosen]], owner[chosen]))]
            who, x = owner[at], what[asked[at]]
            first = _starts(who, x)
            parts.append((kind, keys[who[first]], x[first], np.add.reduceat(times[at], first) if len(first) else first, None))

        lost = np.flatnonzero(~seen[asked])
        some(2, lost[common[which[asked[lost]]]], ids[which])
        packs = []
        if k == 2:
            some(3, lost, g[0])
        else:
            lower = _gram_id(g[:-1])
            rest = _find(hot[k - 1].ids, lower) < 0
            some(2, lost[~rest[asked[lost]]], lower)
            lost = lost[rest[asked[lost]]]
            kept = np.flatnonzero(known & rest)
            which = np.concatenate((asked[lost], kept))
            packs = list(_packed(
                g[:-1, which], np.concatenate((owner[lost], np.full(len(kept), -1))), np.concatenate((times[lost], np.zeros(len(kept), np.int64))),
                np.concatenate((np.zeros(len(lost), np.int64), n[kept])), keys, hot, shards))
        names = [x.split()[0] for x in _OUT.split(", ")]
        batches = []
        for kind, key, what, count, sums in parts:
            m = len(count)
            zero = np.zeros(m, np.int64)
            batches.append(pa.RecordBatch.from_arrays([
                pa.array(np.full(m, kind, np.int32)), pa.array(zero if key is None else key), pa.array(zero) if what is None else _signed(what),
                pa.array(count.astype(np.int64)), pa.array(np.zeros(m) if sums is None else sums), *[pa.nulls(m, pa.binary())] * len(_BLOBS)], names))
        for p in packs:
            batches.append(pa.RecordBatch.from_arrays([
                pa.array([4], pa.int32()), pa.array([p[0]], pa.int64()), pa.array([0], pa.int64()), pa.array([0], pa.int64()), pa.array([0.0]),
                *(pa.array([x], pa.binary()) for x in p[1:])], names))
        return pa.Table.from_batches(batches)

    return run


_TERMS = "key long, word long, joined boolean, n long, n_known long, base double, score double"


def _counter(frequent, total: int, kinds: int, order: int, grams):
    """Rows per text: one with the terms of its frequent words and broadcast
    grams (its word is an arbitrary value that spreads such rows), and one for each other word with
    its count, whose terms come from a join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = frequent.value
        ids, values = grams.value
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for b in tokens.blocks(batch.column(1)):
                rows, own = _sequence(b, order)
                token, hot = rows[0], _find(ids, _gram_id(_prints(rows)))
                texts = len(b.bounds) - 1
                at = np.minimum(np.searchsorted(words, token), max(0, len(words) - 1))
                common = words[at] == token if len(words) else np.zeros(len(token), bool)
                c = counts[at[common]] if len(words) else np.zeros(0)
                mine = own[common]
                base = np.bincount(mine, np.log10((c + 1) / (total + kinds + 1)), texts).astype(float)
                score = np.bincount(own[hot >= 0], values[hot[hot >= 0]], texts).astype(float)
                own_keys = keys[b.first:b.first + texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own_keys), pa.array(own_keys), pa.array(np.zeros(texts, bool)), pa.array(np.bincount(own, minlength=texts).astype(np.int64)),
                     pa.array(np.bincount(mine, minlength=texts).astype(np.int64)), pa.array(base), pa.array(score)],
                    [x.split()[0] for x in _TERMS.split(", ")])
                rare = np.flatnonzero(~common)
                rare = rare[np.lexsort((token[rare], own[rare]))]
                first = np.flatnonzero(np.concatenate((np.ones(min(1, len(rare)), bool), (own[rare][1:] != own[rare][:-1]) | (token[rare][1:] != token[rare][:-1]))))
                n = np.diff(np.append(first, len(rare)))
                some = np.zeros(len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[b.first + own[rare[first]]]), _signed(token[rare[first]]), pa.array(np.ones(len(first), bool)), pa.array(n), pa.array(np.zeros(len(first), np.int64)), pa.array(some), pa.array(some)],
                    [x.split()[0] for x in _TERMS.split(", ")])

    return run


def _hot_values(hot: dict[int, Hot], followers: dict[int, int], words: dict[int, float], order: int) -> dict[int, float]:
    """By id, the logarithm of the back-off weight of every broadcast context
    and of the probability of every broadcast gram."""
    values: dict[int, float] = {}
    for k in range(2, order + 1):
        grams, contexts = hot[k], hot[1 - k]
        by_gram = _context_id(grams.words.T[1:]) if len(grams.ids) else grams.ids
        own = _find(contexts.ids, by_gram)  # a gram's context and its last words are at least as frequent
        counts = np.array([followers.get(int(x), 0) for x in contexts.ids.view(np.int64)], np.int64) + np.bincount(own[grams.n > 0], minlength=len(contexts.ids))
        for x, n, f in zip(contexts.ids.view(np.int64).tolist(), contexts.n.tolist(), counts.tolist()):
            values[x] = float(np.log10(DISCOUNT * f / n)) if n and f else 0.0
        lower = _gram_id(grams.words.T[:-1]).view(np.int64) if k > 2 and len(grams.ids) else None
        for i, (x, n) in enumerate(zip(grams.ids.view(np.int64).tolist(), grams.n.tolist())):
            at = own[i]
            if n:
                values[x] = float(np.log10((n - DISCOUNT) / contexts.n[at]))
            else:
                values[x] = values[int(contexts.ids.view(np.int64)[at])] + (words[int(grams.words[i, 0])] if lower is None else values[int(lower[i])])
    return values


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", order: int = 2) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score for
    every row; the model is trained on the rows where ``training`` is true.

    ``base_score`` is the add-one unigram log10 probability, ``score`` the
    log10 probability under the model of ``order``, at least 2. A null or empty text is the end token alone. Repeated rows
    (same key and text) get equal rows; each counts in training. Rows with a
    null key are scored like others. Without training rows every token has
    probability 1. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"), F.coalesce(training, F.lit(False)).alias("_train"))
    rows = rows.withColumn("_key", F.xxhash64("_id", "_text"))

    counts = stage(rows.select("_text", "_train").mapInArrow(_counts(order), _COUNTS).groupBy("kind", "word").agg(
        F.sum("n").alias("n"), F.max("gram").alias("gram")), "counts")
    unigrams = counts.where("kind = 1").select("word", "n")
    total, kinds = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hot = _hot(rows, counts, counts.where("kind = 0").agg(F.sum("n")).first()[0] or 0, order)
    shared_hot = spark.sparkContext.broadcast(hot)

    texts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("copies"), F.first("_id").alias("_id"), F.first("_train").alias("_train"))
    size = rows.agg(F.sum(F.octet_length("_text") + 6)).first()[0] or 0
    shards = max(12, order * size // (12 * SHARD_TOKENS))
    packs, found = rows.select("_key", "_text", "_train").mapInArrow(_packer(order, shards, shared_hot), _PACK), None
    for k in range(order, 1, -1):
        level = stage(packs.groupBy("shard").applyInArrow(_shard(k, shards, shared_hot), _OUT), f"grams-{k}")
        packs = level.where("kind = 4").select(F.col("key").cast("int").alias("shard"), *_BLOBS)
        level = level.where("kind < 4").select("kind", "key", "word", "n", "value")
        found = level if found is None else found.unionByName(level)

    # Counts by fingerprint of the word, and the values of what is broadcast.
    fingerprint = F.shiftrightunsigned("word", int(_FP))
    model = stage(unigrams.select(fingerprint.alias("word"), "n").groupBy("word").agg(F.sum("n").alias("c")), "model")
    followers = {r[0]: r[1] for r in found.where("kind = 1").groupBy("word").agg(F.sum("n")).collect()}
    asked = sorted({int(x) for x in hot[2].words[:, 0]}) if len(hot[2].ids) else []
    known = {r[0]: r[1] for r in model.where(F.col("word").isin(asked)).collect()} if asked else {}
    values = _hot_values(hot, followers, {x: float(np.log10((known.get(x, 0) + 1) / (total + kinds + 1))) for x in asked}, order)
    shared_grams = spark.sparkContext.broadcast((hot[order].ids, np.array([values[x] for x in hot[order].ids.view(np.int64).tolist()])))
    values = F.broadcast(spark.createDataFrame(list(values.items()), "word long, worth double"))

    frequent = unigrams.where(F.col("n") * FREQUENT > total).toPandas()
    frequent = frequent.assign(word=frequent["word"].to_numpy(np.int64).view(np.uint64)).sort_values("word")
    shared = spark.sparkContext.broadcast((frequent["word"].to_numpy(np.uint64), frequent["n"].to_numpy(float)))
    terms = rows.select("_key", "_text").mapInArrow(_counter(shared, total, kinds, order, shared_grams), _TERMS)
    n, c = F.col("n"), F.coalesce(F.col("c"), F.lit(0))
    p = F.log10((c + 1) / F.lit(float(total + kinds + 1)))
    zero = F.lit(0).cast("long")
    counted = terms.join(unigrams.select("word", F.col("n").alias("c")), "word", "left").select(
        "key", F.when(F.col("joined"), zero).otherwise(n).alias("n_tokens"),
        F.when(~F.col("joined"), F.col("n_known")).when(c > 0, n).otherwise(zero).alias("n_known"),
        F.when(F.col("joined"), n * p).otherwise(F.col("base")).alias("base"),
        "score")
    seen = found.where("kind = 0").select("key", zero.alias("n_tokens"), zero.alias("n_known"), F.lit(0.0).alias("base"), F.col("value").alias("score"))
    sent = lambda x: x.select("key", zero.alias("n_tokens"), zero.alias("n_known"), F.lit(0.0).alias("base"), "score")
    common = sent(found.where("kind = 2").select("key", "word", "n").join(values, "word").withColumn("score", n * F.col("worth")))
    lost = sent(found.where("kind = 3").select("key", "word", "n").join(model, "word", "left").withColumn("score", n * p))
    sums = counted.unionByName(seen).unionByName(common).unionByName(lost).groupBy("key").agg(
        *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "score")])

    out = texts.join(sums, F.col("_key") == F.col("key")).select(
        F.col("_id").alias(key), (~F.col("_train")).alias("held_out"),
        *[(F.col(x) / F.col("copies")).cast("long").alias(x) for x in ("n_tokens", "n_known")],
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return out.drop("_copy")
