"""Phrase collocations by SETM (set-oriented mining over occurrence relations).

Level k has an occurrence relation R_k, one row (position, group) for every
place where a frequent phrase of k words stands, sorted by position. The next
level's occurrences are a merge join of R_k with itself: a group at position p
and one at p + 1 overlap in all but one word, so together they are a phrase of
k + 1 words. Those occurrences are counted by group, groups below the least
count are dropped, and the occurrences are semi-joined with the groups that
are left before the next length is tried. A phrase has no more occurrences
than its parts, so nothing frequent is lost.

A relation is written as blocks of whole texts: positions number the words of
a block and skip one at every piece's end, so adjacent positions are adjacent
words of one piece, and a merge join needs no rows of another block. Counting
is pre-aggregated per task; Spark sums the counts. The dictionary of frequent
words and the sorted codes of frequent groups are broadcast in parts of
bounded size; with more than one part, each part gives its share of a block's
occurrences and the shares are merged block by block.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import batches_of, lookup, running_totals, stage

# Words and groups in one broadcast part.
WORDS_PART = 600_000
GROUPS_PART = 16_000_000
# Bytes of text in a block (more only for a longer single text).
BLOCK = 1 << 20
# Entries that a task gathers before it passes its counts on.
GATHERED = 2_000_000
VOCABULARY = 300_000

_BREAK = b"."
# A-Z in lower case, every piece end a full stop; space and tab stay.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_RELATION = "block long, position binary, code binary"
_SCALE = 1_000_000


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes]]:
    """(group, normalised texts of that group, joined by piece ends)."""
    parts: dict[bytes, list[bytes]] = {}
    size: dict[bytes, int] = {}
    for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        parts.setdefault(group, []).append(text.translate(_NORMAL))
        size[group] = size.get(group, 0) + len(text)
        if size[group] >= BLOCK:
            yield group, _BREAK.join(parts.pop(group))
            del size[group]
    for group, texts in parts.items():
        yield group, _BREAK.join(texts)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, word, n) of the task; the null word holds the number of words."""
    found: dict[bytes, Counter] = {}

    def flush():
        for group, counts in found.items():
            words = [*counts, None]
            sizes = [*counts.values(), sum(counts.values())]
            yield pa.RecordBatch.from_arrays([pa.array([group] * len(words), pa.binary()), pa.array(words, pa.binary()), pa.array(sizes, pa.int64())], ["group", "word", "n"])
        found.clear()

    for batch in batches:
        for group, data in _blocks(batch):
            found.setdefault(group, Counter()).update(data.replace(_BREAK, b" ").split())
            if sum(map(len, found.values())) > VOCABULARY:
                yield from flush()
    yield from flush()


def _related(block: int, position: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
    steps = np.diff(position, prepend=0).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([steps.tobytes()], pa.binary()), pa.array([code.astype(np.int32).tobytes()], pa.binary())], ["block", "position", "code"])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, positions, codes) of the relation's blocks, one at a time."""
    for block, steps, code in zip(*batch.columns, strict=True):
        yield block.as_py(), np.cumsum(np.frombuffer(steps.as_buffer(), np.int32), dtype=np.int64), np.frombuffer(code.as_buffer(), np.int32).astype(np.int64)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of normalised text with numbers that later passes share."""
    number = itertools.count(TaskContext.get().partitionId() << 32)
    for batch in batches:
        for group, data in _blocks(batch):
            yield pa.RecordBatch.from_arrays([pa.array([next(number)], pa.int64()), pa.array([group], pa.binary()), pa.array([data], pa.binary())], ["block", "group", "data"])


def _occurrences(words):
    """R_1 of the words in the broadcast part, from texts or numbered blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        none: dict[bytes, int] = {}
        for batch in batches:
            numbered = batch.num_columns == 3
            for item in zip(*(c.to_pylist() for c in batch.columns), strict=True) if numbered else _blocks(batch):
                block, (group, data) = (item[0], item[1:]) if numbered else (next(number), item)
                tokens = data.replace(_BREAK, b" . ").split()
                ids = np.fromiter(map(words.value.get(group, none).get, tokens, itertools.repeat(-1)), np.int64, len(tokens))
                position = np.flatnonzero(ids >= 0)
                if len(position):
                    yield _related(block, position, ids[position])

    return run


def merge_join(position: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows at adjacent positions of a sorted relation without equal
    positions: the first one's position, and both codes in one number."""
    at = np.flatnonzero(position[1:] == position[:-1] + 1)
    return position[at], code[at] << 32 | code[at + 1]


def _group_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n) of the joined occurrences, summed over the task's blocks."""
    held: list[np.ndarray] = []

    def flush():
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        for i in range(0, len(codes), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(codes[i:i + (1 << 16)]), pa.array(n[i:i + (1 << 16)].astype(np.int64))], ["code", "n"])

    for batch in batches:
        for _, position, code in _rows(batch):
            held.append(merge_join(position, code)[1])
            if sum(map(len, held)) > GATHERED:
                yield from flush()
    if held:
        yield from flush()


def _semi_joined(groups):
    """R_k+1: joined occurrences whose group is in the broadcast part, which is
    (number of its first group, sorted codes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, codes = groups.value
        for batch in batches:
            for block, position, code in _rows(batch):
                position, code = merge_join(position, code)
                at = np.searchsorted(codes, code)
                there = np.flatnonzero(at < len(codes))
                there = there[codes[at[there]] == code[there]]
                if len(there):
                    yield _related(block, position[there], at[there] + first)

    return run


def _merged(table: pa.Table) -> pa.Table:
    """One block's rows from all parts, sorted by position."""
    parts = [p for batch in table.to_batches() for p in _rows(batch)]
    position, code = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    order = np.argsort(position)
    return pa.Table.from_batches([_related(parts[0][0], position[order], code[order])])


def _in_parts(source: DataFrame, total: int, size: int, part, label: str) -> DataFrame:
    """The relation that ``part(first, last)`` gives, a function for mapInArrow
    that knows the groups first to last - 1, over all ``total`` groups."""
    shares = [source.mapInArrow(part(i, min(i + size, total)), _RELATION) for i in range(0, max(total, 1), size)]
    if len(shares) == 1:
        return stage(shares[0], label)
    every = stage(shares[0], f"{label}-share")
    for share in shares[1:]:
        every = every.unionByName(stage(share, f"{label}-share"))
    return stage(every.groupBy("block").applyInArrow(_merged, _RELATION), label)


def _frequent_words(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Words of at least that count, numbered by (group, word), and the number
    of words of each group."""
    counts = texts.mapInArrow(_word_counts, "group binary, word binary, n long").groupBy("group", "word").agg(F.sum("n").alias("n"))
    counts = stage(counts.where((F.col("n") >= least) | F.col("word").isNull()), "words")
    one = counts.where("word is not null").withColumn("_one", F.lit(1).cast("long"))
    words = running_totals(one, ["group", "word"], "_one", name="id").drop("_one")
    return stage(words, "numbered-words"), counts.where("word is null").select("group", F.col("n").alias("total"))


def score(a: str, first: str, rest: str) -> F.Column:
    """floor(1000000 * a * a / (first * rest)), in exact decimals."""
    d = "cast({} as decimal(19, 0))".format
    return F.expr(f"cast({d(a)} * {d(a)} * {_SCALE} as decimal(38, 0)) div cast({d(first)} * {d(rest)} as decimal(38, 0))")


def _candidates(level: DataFrame, k: int) -> DataFrame:
    """Scores of a level's phrases by their weakest cut; of equal ones the
    shortest first part."""
    cuts = [F.struct(score("n", f"prefix[{j - 1}]", f"suffix[{k - j - 1}]").alias("score"), F.lit(j).alias("cut"),
                     F.col("prefix")[j - 1].alias("l"), F.col("suffix")[k - j - 1].alias("r")) for j in range(1, k)]
    weakest = level.withColumn("_cut", F.array_min(F.array(*cuts)))
    return weakest.select("id", "group", "words", F.col("n").alias("a"), "_cut.l", "_cut.r", "_cut.score")


def _next_level(level: DataFrame, counts: DataFrame) -> DataFrame:
    """The level above: each code joined with both of its parts."""
    rows = counts.select("id", "n", F.shiftright("code", 32).alias("_left"), F.col("code").bitwiseAND(0xFFFFFFFF).alias("_right"))
    left = level.select(F.col("id").alias("_left"), "group", F.col("words").alias("_words"), F.col("prefix").alias("_prefix"))
    right = level.select(F.col("id").alias("_right"), F.element_at("words", -1).alias("_last"), F.col("suffix").alias("_suffix"))
    both = lookup(lookup(rows, stage(left, "first-parts"), ["_left"]), stage(right, "last-parts"), ["_right"])
    return stage(both.select("id", "n", "group", "_left", "_right", F.concat("_words", F.array("_last")).alias("words"),
                             F.concat("_prefix", F.array("n")).alias("prefix"), F.concat("_suffix", F.array("n")).alias("suffix")), "level")


def mine(docs: DataFrame, text: str = "text", group: str = "lang", longest: int = 3, least: int = 10, keep: int = 2000) -> DataFrame:
    """The ``keep`` best phrases of 2 to ``longest`` words of every group:
    group, rank (from 1), phrase, a (its occurrences), l and r (those of the
    two sides of its weakest cut), n (words of the group) and score.

    Texts are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and line
    ends, pieces into words at spaces and tabs. A phrase counts with at least
    ``least`` occurrences inside pieces, overlapping ones included. Its score
    is that of its weakest cut, a * a / (l * r) in millionths; a phrase is
    left out when one that is one or more words longer and holds it occurs at
    least half as often. Null texts are empty, a null group is ``und``; a
    repeated row counts again; equal scores are ordered by count, then by
    phrase in byte order. Very long texts are a block of their own. An empty
    table, or texts without a frequent phrase, give no rows.
    """
    with batches_of(docs.sparkSession):  # every pass over blocks is written in here
        return _mined(docs, text, group, longest, least, keep)


def _mined(docs: DataFrame, text: str, group: str, longest: int, least: int, keep: int) -> DataFrame:
    spark = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).cast("binary").alias("group"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("data"))
    words, totals = _frequent_words(texts, least)
    total = words.count()

    def dictionary(first: int, last: int):
        part: dict[bytes, dict[bytes, int]] = {}
        for g, w, i in zip(*(c.to_pylist() for c in words.where(F.col("id").between(first, last - 1)).select("group", "word", "id").toArrow().columns), strict=True):
            part.setdefault(g, {})[w] = i
        return _occurrences(spark.broadcast(part))

    source = texts if total <= WORDS_PART else stage(texts.mapInArrow(_numbered, "block long, group binary, data binary"), "blocks")
    relation = _in_parts(source, total, WORDS_PART, dictionary, "occurrences-1")
    level = stage(words.select("id", "n", "group", F.array("word").alias("words"), F.array("n").alias("prefix"), F.array("n").alias("suffix")), "level")
    found, below = None, None
    for k in range(2, longest + 1):
        # Each task has summed its own rows, so they are dealt out as they are.
        counts = relation.mapInArrow(_group_counts, "code long, n long").repartition("code").groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        counts = stage(counts, "group-counts").withColumn("_one", F.lit(1).cast("long"))
        counts = stage(running_totals(counts, ["code"], "_one", name="id").drop("_one"), "groups")
        level = _next_level(level, counts)
        total = counts.count()
        if below is not None:
            found = _not_covered(found, below, level)
        below = _candidates(level, k)
        if not total or k == longest:
            break

        def codes(first: int, last: int, counts=counts):
            part = counts.where(F.col("id").between(first, last - 1)).select("code").toArrow().column(0).to_numpy()
            return _semi_joined(spark.broadcast((first, np.sort(part))))

        relation = _in_parts(relation, total, GROUPS_PART, codes, f"occurrences-{k}")
    kept = below.drop("id") if found is None else found.unionByName(below.drop("id"))
    phrases = kept.withColumn("phrase", F.array_join(F.transform("words", lambda w: w.cast("string")), " "))
    phrases = phrases.select("*", (-F.col("score")).alias("_worse"), (-F.col("a")).alias("_rarer"), F.lit(1).cast("long").alias("_one"))
    ranked = running_totals(phrases, ["_worse", "_rarer", "phrase"], "_one", ["group"], name="rank")
    ranked = ranked.withColumn("rank", F.col("rank") + 1).where(F.col("rank") <= keep)
    return lookup(stage(ranked, "ranked"), stage(totals, "totals"), ["group"]).select(
        F.col("group").cast("string").alias(group), "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def _not_covered(found: DataFrame | None, below: DataFrame, level: DataFrame) -> DataFrame:
    """Add to ``found`` the phrases below that no phrase of the level covers: a
    longer phrase still that covers one has a part of this length that does."""
    over = level.select(F.explode(F.array("_left", "_right")).alias("id"), "n").groupBy("id").agg(F.max("n").alias("_over"))
    left = lookup(below, stage(over, "covers"), ["id"], "left")
    left = left.where(F.col("_over").isNull() | (F.lit(2) * F.col("_over") < F.col("a"))).drop("id", "_over")
    return left if found is None else found.unionByName(left)
