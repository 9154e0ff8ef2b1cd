"""Alignment of two tokenizers by byte boundaries, with corpus-wide link counts.

Both token sequences of a text spell the same bytes. Offsets where a token of
each side ends cut them into groups, and every pair of an A and a B token of
one group is a link. A link's count is the number of documents that hold its
pair of ids.

The first pass encodes and aligns every document, writes the ids, and gives
each task's document counts of distinct pairs. The distinct pairs get a
minimal perfect hash (levels of bit arrays as in BBHash, built per bucket of
pairs in Spark; a pair's rank among the set bits is its hash). Counts are then
dense vectors indexed by hash: each task fills its own, and the vectors are
summed in two levels of a tree. The second pass aligns the written ids again
and looks every link up; the key stored at a hash must equal the pair. Hash,
keys and counts are broadcast in parts of at most ``PART_PAIRS`` pairs; more
pairs are looked up part after part and the sums of the parts are added.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import stage

# Pairs in one broadcast part: about 70 MB with keys and counts.
PART_PAIRS = 8_000_000
# Pairs in one bucket of the hash, on average.
BUCKET_PAIRS = 1 << 18
# Bytes of text aligned at once (more only for a longer single text), links
# expanded at once, and pairs that a task gathers before it passes them on.
CHUNK = 1 << 20
LINKS = 1 << 21
GATHERED = 1 << 22
# Groups with more links than this are first reduced to distinct ids.
LARGE_GROUP = 1 << 14
_LEVELS = 64

# Fixed value: the public pattern of byte-level BPE pre-tokenization.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """Byte for each character of byte-level token strings: printable bytes
    stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with their tokens' bytes, from the files' contents."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece

        spec = json.loads(byte_level)
        special = {t["id"] for t in spec.get("added_tokens", ())}
        byte = _byte_of()
        vocab = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special}
        self.a_bytes = _table(vocab, max([*vocab.values(), *special]) + 1)
        self._a = self._ranked(spec, vocab) or self._library(byte_level)
        self._b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        own = {}
        for i in range(self._b.vocab_size()):
            piece = self._b.id_to_piece(i)
            if self._b.is_byte(i):
                own[i] = bytes([int(piece[3:-1], 16)])
            elif not (self._b.is_control(i) or self._b.is_unknown(i)):
                own[i] = piece.replace("▁", " ").encode()
        self.b_bytes = [own.get(i, b"") for i in range(self._b.vocab_size())]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)

    @staticmethod
    def _ranked(spec: dict, vocab: dict[bytes, int]):
        """Merging by ids as ranks, which is the fastest encoder, if the file's
        merges come in the order of the ids they make and nothing but the usual
        split at the pattern goes before."""
        import tiktoken

        split = spec.get("pre_tokenizer") or {}
        names = spec["model"]["vocab"]
        made = [names.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in spec["model"]["merges"]]
        usual = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        single = max(i for t, i in vocab.items() if len(t) == 1)
        if not usual or spec.get("normalizer") or spec["model"].get("ignore_merges") or len(made) + 256 != len(vocab) or single > 255 or made != sorted(set(made)) or made[:1] and made[0] != 256:
            return None
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={}).encode_ordinary

    @staticmethod
    def _library(byte_level: bytes):
        from tokenizers import Tokenizer

        own = Tokenizer.from_str(byte_level.decode())
        own.encode_special_tokens = True
        return lambda text: own.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """A ids of space+text and B ids of text; none for a null or empty text
        or one that either side does not spell."""
        if not text:
            return [], []
        a, b, spelt = self._a(" " + text), self._b.encode(text), b" " + text.encode("utf-8", "surrogatepass")
        ta, tb = self.a_bytes, self.b_bytes
        if b"".join([ta[i] for i in a]) != spelt or b"".join([tb[i] for i in b]) != spelt or 0 in self.b_size[b]:
            return [], []
        return a, b


def _table(vocab: dict[bytes, int], size: int) -> list[bytes]:
    out = [b""] * size
    for token, i in vocab.items():
        out[i] = token
    return out


class Aligned(NamedTuple):
    """Groups of some texts' concatenated tokens. ``a`` and ``b`` are ids,
    ``of_a`` and ``of_b`` the groups of the tokens, ``n_a`` and ``n_b`` the
    groups' sizes, ``ends_a`` and ``ends_b`` mark the last tokens of groups."""

    a: np.ndarray
    b: np.ndarray
    of_a: np.ndarray
    of_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


def align(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> Aligned:
    """Cut both id sequences, which spell the same bytes, at common token ends."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    end_a, end_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    mark = np.zeros((int(end_a[-1]) if len(a) else 0) + 1, np.int8)
    mark[end_a] = 1
    mark[end_b] += 2
    last_a, last_b = mark[end_a] == 3, mark[end_b] == 3
    of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    n = int(last_a.sum())
    return Aligned(a, b, of_a, of_b, np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n), last_a, last_b)


def _reduced(ids: np.ndarray, group: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, groups, multiplicities) with equal ids of large groups made one."""
    big = large[group]
    own, n = np.unique(group[big] << 32 | ids[big], return_counts=True)
    i = np.concatenate((ids[~big], own & 0xFFFFFFFF))
    g = np.concatenate((group[~big], own >> 32))
    order = np.argsort(g, kind="stable")
    return i[order], g[order], np.concatenate((np.ones(int((~big).sum()), np.int64), n))[order]


def links(x: Aligned, n_ids_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, pair, multiplicity) of all links, a bounded number at a time; a
    pair is a * n_ids_b + b. Groups come in order."""
    large = x.n_a * x.n_b > LARGE_GROUP
    a, of_a, times_a = x.a, x.of_a, None
    b, of_b, times_b = x.b, x.of_b, None
    if large.any():
        a, of_a, times_a = _reduced(a, of_a, large)
        b, of_b, times_b = _reduced(b, of_b, large)
    n_b = np.bincount(of_b, minlength=len(x.n_b))
    first_b = np.cumsum(n_b) - n_b
    each = n_b[of_a]
    before = np.cumsum(each) - each
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(before, before[i] + LINKS, "right")) - 1)
        k = each[i:j]
        at_a = np.repeat(np.arange(i, j), k)
        at_b = np.arange(len(at_a)) - np.repeat(before[i:j] - before[i] - first_b[of_a[i:j]], k)
        times = np.ones(len(at_a), np.int64) if times_a is None else times_a[at_a] * times_b[at_b]
        yield of_a[at_a], a[at_a] * n_ids_b + b[at_b], times
        i = j


def _hashed(keys: np.ndarray, level: int) -> np.ndarray:
    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((level + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) >> np.uint64(20)  # 44 bits, so remainders fit int64


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(sizes of the levels in bits, their bit words, keys by rank) of distinct
    keys: a key that is alone at its bit of a level stays there, the others go
    on to the next level."""
    sizes, words, order, left = [], [], [], keys
    while len(left):
        if len(sizes) == _LEVELS:
            raise ValueError("keys are not distinct")
        size = 64 * max(1, math.ceil(len(left) * 2 / 64))
        at = (_hashed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        order.append(left[alone][np.argsort(at[alone])])
        sizes.append(size)
        left = left[~alone]
    return sizes, np.concatenate(words) if words else np.zeros(0, np.uint64), np.concatenate(order) if order else keys


class PairTable:
    """The hash of some buckets' pairs with keys and, once known, counts."""

    def __init__(self, n_buckets: int, rows: list):
        """``rows``: (bucket, sizes, words, keys, counts or None) of the buckets."""
        self.n_buckets = n_buckets
        depth = max((len(r[1]) for r in rows), default=0)
        self.size, self.start = np.zeros((depth, n_buckets), np.int64), np.zeros((depth, n_buckets), np.int64)
        self.first, at, n = {}, 0, 0
        for bucket, sizes, _, keys, _ in rows:
            self.first[bucket] = (n, n + len(keys))
            n += len(keys)
            for level, size in enumerate(sizes):
                self.size[level, bucket], self.start[level, bucket] = size, at
                at += size
        join = lambda i, t: np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, t)
        self.words, self.keys = join(2, np.uint64), join(3, np.int64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.rank = np.cumsum(ones) - ones
        self.counts = join(4, np.int64) if rows and rows[0][4] is not None else None

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Hash of each pair, -1 where the key stored there is another."""
        out = np.full(len(pairs), -1, np.int64)
        bucket, left = pairs % self.n_buckets, np.arange(len(pairs))
        for level in range(len(self.size)):
            size = self.size[level, bucket]
            if not size.all():
                there = np.flatnonzero(size)
                left, bucket, size = left[there], bucket[there], size[there]
            if not len(left):
                break
            bit = self.start[level, bucket] + (_hashed(pairs[left], level) % size.astype(np.uint64)).astype(np.int64)
            word, low = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> low & np.uint64(1)).astype(bool)
            at = np.flatnonzero(hit)
            out[left[at]] = self.rank[bit[at] >> 6] + np.bitwise_count(word[at] & ((np.uint64(1) << low[at]) - np.uint64(1)))
            rest = np.flatnonzero(~hit)
            left, bucket = left[rest], bucket[rest]
        found = np.flatnonzero(out >= 0)
        out[found[self.keys[out[found]] != pairs[found]]] = -1
        return out


_LOADED: dict[str, Tokenizers] = {}


def _tokenizers(files) -> Tokenizers:
    """The worker's tokenizers, made once for (digest, broadcast contents)."""
    digest, contents = files
    if digest not in _LOADED:
        _LOADED.clear()
        _LOADED[digest] = Tokenizers(*contents.value)
    return _LOADED[digest]


def _chunks(weights: list[int]) -> Iterator[tuple[int, int]]:
    i, held = 0, 0
    for j, w in enumerate(weights):
        if j > i and held + w > CHUNK:
            yield i, j
            i, held = j, 0
        held += w
    if i < len(weights):
        yield i, len(weights)


def _binary(values) -> pa.Array:
    return pa.array(values, pa.binary())


def _first_pass(files, n_row: pa.DataType):
    """Rows (_row, _doc, a, b) of the documents, and rows of pair counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizers(files)
        held: list[np.ndarray] = []
        names = ["_row", "_doc", "a", "b", "pairs", "n"]

        def flush():
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.nulls(1, n_row), pa.nulls(1, pa.int64()), _binary([None]), _binary([None]),
                                                  _binary([np.diff(pairs, prepend=0).astype(np.uint32).tobytes()]), _binary([n.astype(np.uint32).tobytes()])], names)

        for batch in batches:
            row, doc, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for i, j in _chunks([len(t or "") for t in texts]):
                both = [tok.encode(t) for t in texts[i:j]]
                a, b = [np.array(x, np.uint16) for x, _ in both], [np.array(y, np.uint16) for _, y in both]
                x = align(np.concatenate(a), np.concatenate(b), tok.a_size, tok.b_size)
                if len(x.n_a):
                    at = _owner(x, [len(t) for t in a])
                    parts = [np.unique(at[g] << 32 | pair) for g, pair, _ in links(x, len(tok.b_bytes))]
                    held.append(np.unique(np.concatenate(parts)) & 0xFFFFFFFF)
                yield pa.RecordBatch.from_arrays([row.slice(i, j - i), doc.slice(i, j - i), _binary([t.tobytes() for t in a]), _binary([t.tobytes() for t in b]),
                                                  _binary([None] * (j - i)), _binary([None] * (j - i))], names)
                if sum(map(len, held)) > GATHERED:
                    yield from flush()
        if held:
            yield from flush()

    return run


def _owner(x: Aligned, sizes: list[int]) -> np.ndarray:
    """Text of each group, from the texts' numbers of A tokens."""
    return np.repeat(np.arange(len(sizes)), sizes)[np.flatnonzero(x.ends_a)]


def _pairs_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for steps, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        yield np.cumsum(np.frombuffer(steps, np.uint32), dtype=np.int64), np.frombuffer(n, np.uint32).astype(np.int64)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, _ in _pairs_of(batch):
            for i in range(0, len(pairs), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[i:i + (1 << 16)])], ["pair"])


def _built(table: pa.Table) -> pa.Table:
    """One bucket's hash."""
    keys = np.sort(table.column("pair").to_numpy())
    sizes, words, order = build_hash(keys)
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "size": pa.array([len(keys)], pa.int64()), "sizes": _binary([np.array(sizes, np.int64).tobytes()]),
                     "words": _binary([words.tobytes()]), "keys": _binary([order.astype(np.uint32).tobytes()])})


def _vectors(table, groups: int):
    """Each task's dense count vector, cut at the buckets' bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = table.value
        counts = np.zeros(len(own.keys), np.int64)
        for batch in batches:
            for pairs, n in _pairs_of(batch):
                at = own.find(pairs)
                there = at >= 0
                counts[at[there]] += n[there]
        for bucket, (i, j) in own.first.items():
            if counts[i:j].any():
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([TaskContext.get().partitionId() % groups], pa.int64()), _binary([_packed(counts[i:j])])], ["bucket", "branch", "counts"])

    return run


def _packed(counts: np.ndarray) -> bytes:
    """The vector in four bytes a count, or eight if one needs them."""
    return b"4" + counts.astype(np.uint32).tobytes() if counts.max(initial=0) < 1 << 32 else b"8" + counts.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint32 if raw[:1] == b"4" else np.int64, offset=1).astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of one branch's vectors, a vector at a time."""
    total, head = None, None
    for batch in batches:
        for raw in batch.column("counts"):
            one = _unpacked(raw.as_py())
            total = one if total is None else total + one
        head = head if batch.num_rows == 0 or head is not None else [batch.column("bucket").slice(0, 1), batch.column("branch").slice(0, 1)]
    yield pa.RecordBatch.from_arrays([*head, _binary([_packed(total)])], ["bucket", "branch", "counts"])


def _best_counts(n_ids_b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, n = np.frombuffer(keys, np.uint32).astype(np.int64) // n_ids_b, _unpacked(counts)
                ids, own = np.unique(a, return_inverse=True)
                top = np.zeros(len(ids), np.int64)
                np.maximum.at(top, own, n)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(top)], ["a", "n"])

    return run


def _texts_of_groups(x: Aligned, names_a: np.ndarray, names_b: np.ndarray, sizes_a: list[int], sizes_b: list[int]) -> Iterator[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text, hashed; '' without tokens. The name
    tables hold each id twice: followed by a comma, and by its group's end."""
    out = np.empty(len(x.a) + len(x.b), object)
    first_b = np.cumsum(x.n_b) - x.n_b
    out[np.arange(len(x.a)) + first_b[x.of_a]] = names_a[2 * x.a + x.ends_a]
    out[np.arange(len(x.b)) + np.cumsum(x.n_a)[x.of_b]] = names_b[2 * x.b + x.ends_b]
    i = 0
    for n in (p + q for p, q in zip(sizes_a, sizes_b, strict=True)):
        yield hashlib.sha256(b"".join(out[i:i + n].tolist())[:-1]).hexdigest() if n else ""
        i += n


def _names(n: int, end: str) -> np.ndarray:
    out = np.empty(2 * n, object)
    out[0::2] = [f"{i},".encode() for i in range(n)]
    out[1::2] = [f"{i}{end}".encode() for i in range(n)]
    return out


_RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _second_pass(files, table, best, whole: bool):
    """Aligns the written ids again and looks the links up. With ``whole`` the
    table is all there is and a pair that it lacks is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, own, top = _tokenizers(files), table.value, best.value
        names_a, names_b = _names(len(tok.a_bytes), "|"), _names(len(tok.b_bytes), ";")
        for batch in batches:
            a, b = ([np.frombuffer(t, np.uint16) for t in batch.column(c).to_pylist()] for c in (2, 3))
            for i, j in _chunks([2 * len(t) for t in a]):
                size_a, size_b = [len(t) for t in a[i:j]], [len(t) for t in b[i:j]]
                x = align(np.concatenate(a[i:j]), np.concatenate(b[i:j]), tok.a_size, tok.b_size)
                at = _owner(x, size_a)
                n = {c: np.zeros(j - i, np.int64) for c in _RESULT}
                n["n_a"][:], n["n_b"][:] = size_a, size_b
                np.add.at(n["n_groups"], at, 1)
                np.add.at(n["n_links"], at, x.n_a * x.n_b)
                for group, pair, times in links(x, len(tok.b_bytes)):
                    found = own.find(pair)
                    if whole and (found < 0).any():
                        raise ValueError("a link without a count")
                    count = np.where(found < 0, 0, own.counts[found]) if len(own.keys) else np.zeros(len(pair), np.int64)
                    np.add.at(n["count_sum"], at[group], count * times)
                    np.add.at(n["n_best"], at[group], np.where((found >= 0) & (count == top[pair // len(tok.b_bytes)]), times, 0))
                hashes = list(_texts_of_groups(x, names_a, names_b, size_a, size_b))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), *(pa.array(n[c]) for c in _RESULT), pa.array(hashes, pa.string())],
                                                 ["_row", "_doc", *_RESULT, "groups_sha256"])

    return run


def _odd(n: int) -> int:
    return n | 1


def pair_index(counted: DataFrame, n_ids_b: int) -> tuple[DataFrame, int, list[tuple[int, int]]]:
    """(bucket, size, sizes, words, keys, counts) for all distinct pairs of the
    tasks' counts, the number of buckets, and ranges of buckets to broadcast."""
    spark = counted.sparkSession.sparkContext
    distinct = stage(counted.mapInArrow(_pair_rows, "pair long").distinct(), "pairs")
    n_buckets = _odd(math.ceil(max(distinct.count(), 1) / BUCKET_PAIRS))
    bucketed = distinct.select("pair", (F.col("pair") % n_buckets).alias("bucket"))
    built = stage(bucketed.groupBy("bucket").applyInArrow(_built, "bucket long, size long, sizes binary, words binary, keys binary"), "hash")
    ranges, first, held = [], 0, 0
    for bucket, size in built.select("bucket", "size").orderBy("bucket").collect():  # one small row for each bucket
        if held and held + size > PART_PAIRS:
            ranges.append((first, bucket))
            first, held = bucket, 0
        held += size
    ranges.append((first, n_buckets))
    parts = []
    for i, j in ranges:
        table = spark.broadcast(PairTable(n_buckets, _bucket_rows(built, i, j)))
        branches = max(1, math.isqrt(counted.rdd.getNumPartitions()))
        vectors = counted.mapInArrow(_vectors(table, branches), "bucket long, branch long, counts binary")
        vectors = vectors.groupBy("bucket", "branch").applyInArrow(_summed, vectors.schema)
        parts.append(stage(vectors.groupBy("bucket").applyInArrow(_summed, vectors.schema).drop("branch"), "counts"))
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return stage(built.join(counts, "bucket"), "pair-index"), n_buckets, ranges


def _bucket_rows(index: DataFrame, first: int, last: int) -> list:
    """A range of buckets, at most about PART_PAIRS pairs, on the driver."""
    rows = index.where((F.col("bucket") >= first) & (F.col("bucket") < last)).orderBy("bucket").toArrow().to_pylist()
    return [(r["bucket"], np.frombuffer(r["sizes"], np.int64).tolist(), np.frombuffer(r["words"], np.uint64), np.frombuffer(r["keys"], np.uint32).astype(np.int64),
             _unpacked(r["counts"]) if "counts" in r else None) for r in rows]


def link(docs: DataFrame, byte_level: str, pieces: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """_row (a struct of the ``carry`` columns, all of them by default), n_a,
    n_b, n_groups, n_links, n_best (links whose pair has the largest count of
    its A id, ties included), count_sum and groups_sha256 of every document.

    A encodes space+text by the ``byte_level`` file, B the text by the
    ``pieces`` file, both without special tokens. Null and empty texts, and
    those that either side does not spell byte for byte, have no tokens: zeros
    and an empty digest. Repeated rows are documents of their own. Very long
    texts are aligned whole. An empty table gives an empty result.
    """
    spark = docs.sparkSession.sparkContext
    contents = []
    for path in (byte_level, pieces):
        with open(path, "rb") as f:
            contents.append(f.read())
    files = hashlib.sha256(b"".join(contents)).hexdigest(), spark.broadcast(tuple(contents))
    tok = Tokenizers(*contents)
    if max(len(tok.a_bytes), len(tok.b_bytes)) > 1 << 16 or len(tok.a_bytes) * len(tok.b_bytes) > 1 << 32:
        raise ValueError("vocabularies of at most 65,536 ids")
    rows = docs.select(F.struct(*(docs[c] for c in (carry or docs.columns))).alias("_row"), F.monotonically_increasing_id().alias("_doc"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_row"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    first = rows.mapInArrow(_first_pass(files, to_arrow_type(kind)), f"_row {kind.simpleString()}, _doc long, a binary, b binary, pairs binary, n binary")
    first = stage(first, "token-ids", "zstd")
    ids = first.where("_doc is not null").select("_row", "_doc", "a", "b")
    index, n_buckets, ranges = pair_index(first.where("_doc is null").select("pairs", "n"), len(tok.b_bytes))
    best = np.zeros(len(tok.a_bytes), np.int64)
    for a, n in index.select("keys", "counts").mapInArrow(_best_counts(len(tok.b_bytes)), "a long, n long").groupBy("a").agg(F.max("n")).collect():
        best[a] = n  # one row for each id of A's vocabulary
    best = spark.broadcast(best)
    schema = f"_row {kind.simpleString()}, _doc long, " + ", ".join(f"{c} long" for c in _RESULT) + ", groups_sha256 string"
    parts = []
    for i, j in ranges:
        table = spark.broadcast(PairTable(n_buckets, _bucket_rows(index, i, j)))
        parts.append(ids.mapInArrow(_second_pass(files, table, best, len(ranges) == 1), schema))
    if len(parts) == 1:
        return parts[0].drop("_doc")
    every = stage(parts[0], "looked-up")
    for part in parts[1:]:
        every = every.unionByName(stage(part, "looked-up"))
    added = [F.sum(c).alias(c) if c in ("n_best", "count_sum") else F.first(c).alias(c) for c in ("_row", *_RESULT, "groups_sha256")]
    return every.groupBy("_doc").agg(*added).drop("_doc")
