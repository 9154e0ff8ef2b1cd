"""Near-duplicate groups by SetSketch registers (Ertl, VLDB 2021).

Each document is the set of its distinct 5-word shingles. Every shingle is
the source of a Poisson stream of rate ``RATE * REGISTERS`` whose points fall
on random registers; a register keeps the earliest point, so registers of a
union are the minima of registers (``merge``). Points are truncated at 1 and
stored on an exponential scale of base ``BASE``, one byte each. Equal
registers occur with a probability close to the Jaccard similarity, which
makes slices of registers usable as bands.

``near_duplicates`` finds the connected components of the graph that links
documents with ``100 * |intersection| >= 75 * |union|``:

1. one pass over the texts writes size, set digest and registers per document;
   documents with equal sets form one node;
2. ``BANDS`` bands of ``ROWS`` registers deal the nodes into buckets; at the
   threshold a pair shares none of them with a probability of 1e-6;
3. in each round every bucket that still spans several components compares
   its members with one pivot, which is linear in the bucket; a pair goes on
   when the joint likelihood of its registers does not exclude the threshold,
   and is confirmed on the full shingle sets of the two texts. One round
   joins the large groups; then every remaining pair of different components
   that shares a bucket is compared, except those that the sets' differences
   from a common pivot rule out, so no candidate is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .spread import lookup, stage

WORDS = 5
THRESHOLD = 75  # per cent
REGISTERS = 255
BASE = 1.1
RATE = 20.0
BANDS, ROWS = 51, 5
PIVOT_ROUNDS = 1

_STEP = np.uint64(0x9E3779B97F4A7C15)


def registers(elements: np.ndarray, owner: np.ndarray, sets: int) -> np.ndarray:
    """Registers (sets x REGISTERS, one byte) of the sets whose elements, as
    64-bit hashes, are given with the index of their set."""
    low = np.ones((sets, REGISTERS))
    flat, top = low.reshape(-1), np.ones(sets)
    alive, at, drawn = np.arange(len(elements)), np.zeros(len(elements)), 0
    while len(alive):
        width = int(np.clip(60_000 // len(alive), 4, 64))
        counter = (np.arange(width, dtype=np.uint64) + np.uint64(drawn + 1)) * _STEP
        r = tokens.mix(elements[alive][:, None] + counter)
        gap = np.log(((r >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52)
        points = at[alive][:, None] - np.cumsum(gap, axis=1) / (RATE * REGISTERS)
        own = owner[alive]
        early = points < top[own][:, None]
        slot = own[:, None] * REGISTERS + ((r & np.uint64(0xFFF)) * np.uint64(REGISTERS) >> np.uint64(12)).astype(np.int64)
        np.minimum.at(flat, slot[early], points[early])
        at[alive] = points[:, -1]
        drawn += width
        top = low.max(axis=1)
        alive = alive[at[alive] < top[own]]
    return np.clip(np.floor(1 - np.log(low) / np.log(BASE)), 0, 255).astype(np.uint8)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets (or rows of sets)."""
    return np.maximum(a, b)


def _likelihood(greater, less, equal, u, v, j):
    """Log-likelihood of Jaccard similarity ``j`` given how many registers of
    the first set are greater, less and equal; u and v are the sets' shares
    of the summed sizes."""
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    return greater * log(up) + less * log(down) + equal * log(1 - up - down)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joint maximum-likelihood estimate of the Jaccard similarity of rows of
    registers of sets of known sizes, and whether the threshold is within five
    standard deviations of it (by the likelihood ratio) or below it."""
    greater, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    equal = REGISTERS - greater - less
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = most * np.linspace(0, 1, 101)[None, :]
    values = _likelihood(greater, less, equal, u, v, grid)
    best = values.argmax(1)
    j = grid[np.arange(len(best)), best]
    t = THRESHOLD / 100
    at_threshold = _likelihood(greater, less, equal, u, v, t)[:, 0]
    near = 2 * (values.max(1) - at_threshold) <= 25
    return j, (most[:, 0] >= t - 1e-9) & ((j >= t) | near)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tokens.blocks(batch.column(1)):
            h, own = tokens.shingles(tokens.word_hashes(block), block.bounds, WORDS)
            n = len(block.bounds) - 1
            order = np.argsort(own, kind="stable")
            h, cuts = h[order], np.searchsorted(own[order], np.arange(n + 1))
            sets = [np.unique(h[cuts[i]:cuts[i + 1]]) for i in range(n)]
            sizes = np.fromiter(map(len, sets), np.int64, n)
            regs = registers(np.concatenate(sets), np.repeat(np.arange(n), sizes), n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(block.first, n),
                batch.column(2).slice(block.first, n),
                pa.array(sizes),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([r.tobytes() if s else None for r, s in zip(regs, sizes)], pa.binary()),
            ], ["doc", "digest", "n_shingles", "set_key", "registers"])


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, digest (of the text), n_shingles, set_key and registers per row;
    registers are null for texts without words (null, empty, only spaces)."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("digest")).mapInArrow(
        _sketches, f"doc {kind}, digest long, n_shingles long, set_key binary, registers binary")


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("a_registers", "b_registers"))
        keep = np.concatenate([
            estimate(a[i:i + 4096], b[i:i + 4096], batch.column("a_n").to_numpy()[i:i + 4096].astype(float), batch.column("b_n").to_numpy()[i:i + 4096].astype(float))[1]
            for i in range(0, batch.num_rows, 4096)])
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], ["a", "b"]).filter(pa.array(keep))


def _shingle_set(text: str) -> set[tuple[bytes, ...]]:
    words = text.encode().lower().split()
    return set(zip(*(words[i:] for i in range(WORDS)))) if len(words) >= WORDS else {tuple(words)}


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, own = None, set()
    for batch in batches:
        keep = []
        for a, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "a_text", "b_text"))):
            if a != last:  # a pivot's pairs mostly come one after the other
                last, own = a, _shingle_set(ta)
            other = _shingle_set(tb)
            both = len(own & other)
            keep.append(100 * both >= THRESHOLD * (len(own) + len(other) - both))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are confirmed as links. All sides are
    written tables, so the skew join splits the pairs of a hot pivot."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("registers").alias(f"{x}_registers"), F.col("n").alias(f"{x}_n"))
    text = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"{x}_text"))
    likely = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * THRESHOLD)
    likely = stage(likely.mapInArrow(_may_link, "a long, b long"), "likely")
    both = likely.join(text("b"), "b").join(text("a"), "a").select("a", "b", "a_text", "b_text")
    return stage(both.mapInArrow(_confirm, "a long, b long"), "links")


def _components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the links; comp is the smallest node of
    its connected component. Each step takes the smallest label among the
    neighbours, then that label's own label, until nothing changes."""
    edges = stage(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct(), "edges")
    label = stage(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("comp")), "labels")
    while True:
        near = edges.join(label.select(F.col("node").alias("other"), F.col("comp").alias("near")), "other").groupBy("node").agg(F.min("near").alias("near"))
        step = near.join(label, "node").select("node", F.least("near", "comp").alias("mid"), F.col("comp").alias("old"))
        up = label.select(F.col("node").alias("mid"), F.col("comp").alias("up"))
        fresh = stage(step.join(up, "mid").select("node", F.least("mid", "up").alias("comp"), "old"), "labels")
        label = fresh.select("node", "comp")
        if fresh.where("comp < old").isEmpty():
            return label


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, kept.

    ``component_id`` is the smallest key of the row's component, ``kept`` is
    true on rows whose key is the component_id. Texts that are null, empty or
    have no word have the empty set and are a component of their own.
    Repeated rows belong to one component and all get the same answer; a key
    that occurs with different texts has a row for each. Rows with a null key
    take part; their component_id is null only when no member has a key. An
    empty table gives an empty result; other columns are ignored.
    """
    found = _labelled(docs, key, text)
    out = found.select("doc", "n_shingles", "component_id", F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))
    return out.withColumnRenamed("doc", key)


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, digest (xxhash64 of the text) and rows: one key and text for each
    component, with the number of rows that have both. It is the one with the
    smallest key, without a key only when no member has one, and of several
    texts of that key the one with the smallest digest. Texts without words
    stand for themselves, once for each key and text.
    """
    found = _labelled(docs, key, text).groupBy("comp", "doc", "digest").agg(F.count(F.lit(1)).alias("rows"))
    found = stage(found, "keyed")
    least = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "digest", "rows")).alias("least")
    full = found.where("comp is not null").groupBy("comp").agg(least).select("least.doc", "least.digest", "least.rows")
    return full.unionByName(found.where("comp is null").select("doc", "digest", "rows"))


def _labelled(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, digest, n_shingles, comp and component_id of every row; comp tells
    components apart and is null for texts without words."""
    sketch = stage(sketches(docs, key, text), "sketches")
    full = sketch.where("n_shingles > 0")
    nodes = stage(full.groupBy("set_key").agg(
        F.first("n_shingles").alias("n"), F.first("registers").alias("registers"), F.min("doc").alias("least_doc"),
        F.min(F.struct("doc", "digest")).alias("source")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    components = _node_components(docs, nodes, key, text)

    named = nodes.join(components, "node", "left").select("set_key", "least_doc", F.coalesce("comp", "node").alias("comp"))
    named = stage(named, "named")
    smallest = stage(named.groupBy("comp").agg(F.min("least_doc").alias("component_id")), "smallest")
    named = stage(named.join(smallest, "comp").select("set_key", "comp", "component_id"), "named")
    full = full.join(named, "set_key").select("doc", "digest", "n_shingles", "comp", "component_id")
    none = sketch.where("n_shingles = 0").select("doc", "digest", "n_shingles", F.lit(None).cast("long").alias("comp"), F.col("doc").alias("component_id"))
    return full.unionByName(none)


def _node_components(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """(node, comp) for every node that shares a bucket with another."""
    band = F.expr(
        f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(registers, i * {ROWS} + 1, {ROWS})))")
    bands = nodes.select("node", F.explode(band).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.min("node").alias("_least"), F.max("node").alias("_most")).where("_least < _most").select("bucket")
    members = stage(bands.join(shared, "bucket"), "members")

    comps = members.select("node").distinct().withColumn("comp", F.col("node"))
    comps = stage(comps, "comps")
    met = stage(nodes.join(comps, "node").select("node", "n", "registers", F.col("source.doc").alias("_doc"), F.col("source.digest").alias("_digest")), "met")
    read = docs.select(F.col(key).alias("_doc"), F.col(text).alias("text")).withColumn("_digest", F.xxhash64("text"))
    same = (met["_digest"] == read["_digest"]) & met["_doc"].eqNullSafe(read["_doc"])
    texts = stage(read.join(met, same).select("node", "text"), "texts")
    if not texts.groupBy("node").count().where("count > 1").isEmpty():  # repeated rows of the input
        texts = stage(texts.dropDuplicates(["node"]), "texts")

    links, tested = None, None
    for turn in range(PIVOT_ROUNDS + 1):
        now = members.join(comps, "node")
        first = (F.xxhash64("comp", F.lit(turn)) if turn else F.col("comp")).alias("first")
        now = stage(now, "now")
        pivots = now.groupBy("bucket").agg(
            F.min("comp").alias("_low"), F.max("comp").alias("_high"),
            F.min(F.struct(first, F.col("node"), F.col("comp"))).alias("pivot"))
        pivots = stage(pivots.where("_low < _high").select("bucket", F.col("pivot.node").alias("a"), F.col("pivot.comp").alias("a_comp")), "pivots")
        if turn < PIVOT_ROUNDS:
            pairs = now.join(pivots, "bucket").where("comp != a_comp").select(
                F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        else:
            pairs = _remaining(stage(now.join(pivots.select("bucket"), "bucket"), "open"), met, texts)
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        if turn and pairs.isEmpty():
            continue
        found = _links(pairs, met, texts)
        links = found if links is None else links.unionByName(found)
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not found.isEmpty():
            comps = stage(comps.select("node").join(_components(links), "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), "comps")
    return comps


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingles of every text, as sorted hashes."""
    for block in tokens.blocks(texts):
        h, own = tokens.shingles(tokens.word_hashes(block), block.bounds, WORDS)
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(len(block.bounds)))
        for i in range(len(block.bounds) - 1):
            yield np.unique(h[order[cuts[i]:cuts[i + 1]]])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, h): the distinct shingles of every text, as hashes."""
    for batch in batches:
        node = batch.column(0).to_numpy()
        for block in tokens.blocks(batch.column(1)):
            h, own = tokens.shingles(tokens.word_hashes(block), block.bounds, WORDS)
            order = np.lexsort((h, own))
            h, own = h[order], own[order]
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (own[1:] != own[:-1]))) if len(h) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(node[block.first + own[new]]), pa.array(h[new].view(np.int64))], ["node", "h"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(top, node, diff): the shingles that only one of a node and its pivot holds."""
    last, pivot = None, None
    for batch in batches:
        diff = []
        tops, texts = batch.column("top").to_pylist(), batch.column("top_text")
        for i, own in enumerate(_sets(batch.column("text"))):
            if tops[i] != last:  # a pivot's rows mostly come one after the other
                last, pivot = tops[i], next(_sets(texts.slice(i, 1)))
            diff.append(np.setxor1d(own, pivot, assume_unique=True).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("top"), batch.column("node"), pa.array(diff, pa.list_(pa.int64()))], ["top", "node", "diff"])


def _remaining(members: DataFrame, met: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of members of one bucket that are in different components and may
    be linked. A bucket's members are a cluster with the buckets that have the
    same largest component; its first node is their pivot. The members of the
    largest component are compared with other members only.

    With D(u) the symmetric difference of u and the pivot, of d(u) shingles,
    u and v of sizes m and n are linked exactly if at most (m + n) / 7 shingles
    are in one of D(u) and D(v) only, so if D(u) and D(v) share at least
    need = (d(u) + d(v) - (m + n) / 7) / 2 shingles. Members with
    d <= (m + size of the pivot) / 7 are linked to the pivot and go on as a
    pair with it. For any other u the need is positive whatever v is, so both
    must hold one of the d - need + 1 rarest shingles of the other's D, in one
    order for the cluster. Copies of one text differ from it in few and mostly
    rare shingles, so few pairs are made of the copies that are not linked,
    and no link is lost.

    Before that, a shingle that no other member of an open bucket holds cannot
    be shared, so sets with over a quarter of such shingles have no link.
    """
    sizes = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"))
    largest = stage(sizes.groupBy("bucket").agg(F.max(F.struct("size", "comp")).alias("top")).select("bucket", F.col("top.comp").alias("top")), "largest")
    open_ = stage(members.select("node").distinct(), "open-nodes")
    hashed = stage(texts.join(open_, "node").select("node", "text").mapInArrow(_hashes, "node long, h long"), "shingles")
    alone = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("sets"), F.min("node").alias("node")).where("sets = 1").groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    able = met.select("node", "n").join(open_, "node").join(alone, "node", "left").where("4 * coalesce(alone, 0) <= n")
    able = stage(able.select("node"), "able")
    cluster = members.join(able, "node").join(largest, "bucket").where("node != top").select("top", "node", "comp").distinct()
    size = met.select("node", "n")
    cluster = cluster.join(size, "node").join(size.toDF("top", "top_n"), "top")
    cluster = stage(cluster, "cluster")
    diffs = cluster.select("top", "node").join(texts, "node").join(texts.toDF("top", "top_text"), "top").select("top", "node", "text", "top_text").mapInArrow(
        _differences, "top long, node long, diff array<long>")
    cluster = stage(cluster.join(diffs, ["top", "node"]).withColumn("d", F.size("diff").cast("long")).withColumn(
        "free", F.expr("comp != top and 7 * d > n + top_n")), "differences")

    to_pivot = cluster.where("comp != top and not free").select(F.least("top", "node").alias("a"), F.greatest("top", "node").alias("b"))
    # pairs are made in clusters with a free member and another one
    several = cluster.groupBy("top").agg(F.count(F.lit(1)).alias("all"), F.max("free").alias("some")).where("some and all > 1").select("top")
    held = stage(cluster.join(several, "top").select("top", "node", "comp", "n", "top_n", "d", "free", F.explode("diff").alias("h")), "held")
    shared = held.groupBy("top", "h").agg(F.count(F.lit(1)).alias("sets"), F.max("free").alias("some")).where("some and sets > 1")
    # positions of the shared shingles; those that no other member can match come first and count too
    ranked = lookup(held, stage(shared.select("top", "h", "sets"), "shared"), ["top", "h"])
    order = Window.partitionBy("top", "node").orderBy("sets", "h")
    total = F.count(F.lit(1)).over(Window.partitionBy("top", "node"))
    ranked = ranked.withColumn("left", total - F.row_number().over(order) + 1).drop("sets")
    # left: shared shingles from this one on; sizes differ by a third at most, so need >= d - n / 3
    ranked = stage(ranked.where("3 * (d - left) <= n and 14 * left >= if(free, 0, 7 * d + top_n - n)"), "ranked")
    side = lambda x: [F.col(c).alias(f"{x}_{c}") for c in ("node", "comp", "n", "d", "left", "free")]
    u = ranked.where("free").select("top", "h", *side("u"))
    v = ranked.select("top", "h", *side("v"))
    pairs = u.join(v, ["top", "h"]).where(
        "u_comp != v_comp and (not v_free or u_node < v_node) and 4 * u_n >= 3 * v_n and 4 * v_n >= 3 * u_n"
        " and 14 * least(u_left, v_left) >= 7 * (u_d + v_d) - (u_n + v_n)")
    return to_pivot.unionByName(pairs.select(F.least("u_node", "v_node").alias("a"), F.greatest("u_node", "v_node").alias("b")))
