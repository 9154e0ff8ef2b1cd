"""Benchmark decontamination with one Aho-Corasick automaton.

The alphabet is the benchmark's vocabulary: each distinct word of the
normalised questions and answers is one symbol and every other word is a
symbol that no pattern holds, so an automaton has at most 13 states per
window. Every text is scanned once; hits are runs of words and are mapped
back to character offsets of the original text.

A window is 13 consecutive words of an item; an item of fewer words, but not
none, is one window. Automata are built for parts of the benchmark of about
``PART_BYTES`` of text, so what is broadcast and held by a worker is bounded
whatever the benchmark's size; several parts are scanned one after the other
over written intermediate tables.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import stage

WINDOW = 13
PART_BYTES = 4_000_000
# A document is contaminated when at least one in so many of its words is hit.
SHARE = 20

_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_OTHER = "\0"


def words_of(text: str | None) -> list[bytes]:
    """Normalised words: A-Z lower-cased, runs of ASCII letters, digits and
    all characters beyond ASCII. Null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split() if text else []


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Character range of each normalised word in the original text."""
    return [m.span() for m in _WORD.finditer(text)]


def _symbol(i: int) -> str:
    """The i-th symbol: a code point other than NUL and the surrogates."""
    return chr(i + 1 if i + 1 < 0xD800 else i + 1 + 0x800)


class Automaton:
    """Windows of (item id, text) pairs and the items that own them."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.symbols: dict[bytes, str] = {}
        owners: dict[str, set] = {}
        for item, text in items:
            line = "".join(self.symbols.setdefault(w, _symbol(len(self.symbols))) for w in words_of(text))
            for i in range(max(1, len(line) - WINDOW + 1) if line else 0):
                owners.setdefault(line[i:i + WINDOW], set()).add(item)
        self.trie = ahocorasick.Automaton()
        for window, own in owners.items():
            self.trie.add_word(window, (len(window), tuple(own)))
        if owners:
            self.trie.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes], flags: bytearray, items: set) -> None:
        """Mark the words inside occurrences and collect the items."""
        if self.empty:
            return
        line = "".join(map(self.symbols.get, words, itertools.repeat(_OTHER)))
        for last, (size, own) in self.trie.iter(line):
            flags[last + 1 - size:last + 1] = b"\1" * size
            items.update(own)


_built: list = []


def _automaton(part: Broadcast) -> Automaton:
    """Built once per worker; another part replaces it."""
    if not _built or _built[0] is not part.value:
        _built[:] = [part.value, Automaton(part.value)]
    return _built[1]


def spans_of(text: str, flags: bytearray) -> list[dict]:
    """Character ranges of the runs of marked words."""
    at, out = word_offsets(text), []
    for marked, run in itertools.groupby(range(len(flags)), key=flags.__getitem__):
        if marked:
            run = list(run)
            out.append({"start": at[run[0]][0], "end": at[run[-1]][1]})
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scanner(part: Broadcast, last: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                out = {"n_words": [], "flags": [], "items": [], "spans": [], "n_hit": []}
                for text, flags, items in zip(*(rows.column(c).to_pylist() for c in ("_text", "flags", "items"))):
                    words = words_of(text)
                    marks, own = bytearray(flags or bytes(len(words))), set(items or ())
                    _automaton(part).scan(words, marks, own)
                    hits = sum(marks)
                    out["n_words"].append(len(words))
                    out["flags"].append(bytes(marks) if hits else None)
                    out["items"].append(sorted(own))
                    out["n_hit"].append(hits)
                    out["spans"].append(spans_of(text, marks) if hits and last else [])
                columns = [rows.column("_row")]
                if last:
                    columns += [pa.array(out["n_words"], pa.int64()), pa.array(out["n_hit"], pa.int64()),
                                pa.array(out["items"], pa.list_(pa.string())), pa.array(out["spans"], _SPANS)]
                    yield pa.RecordBatch.from_arrays(columns, ["_row", "n_words", "n_hit", "items", "spans"])
                else:
                    columns += [rows.column("_text"), pa.array(out["flags"], pa.binary()), pa.array(out["items"], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, ["_row", "_text", "flags", "items"])

    return scan


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
         item_text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``_row`` (a struct of the carried columns), n_words, n_hit, items (ids
    as strings, sorted), spans (character ranges in the text) and contaminated
    for every row of ``docs``.

    Null or empty texts have no words and are clean; so is everything when the
    benchmark is empty. Items without an id or without words are left out;
    repeated items count once. Repeated rows get equal answers.
    """
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // PART_BYTES
    row = F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)])
    frame = docs.select(row.alias("_row"), F.col(text).alias("_text"), F.lit(None).cast("binary").alias("flags"), F.lit(None).cast("array<string>").alias("items"))
    kind = frame.schema["_row"].dataType.simpleString()
    for i in range(parts):
        own = [(r.item, r.text) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == i).collect()]
        part = docs.sparkSession.sparkContext.broadcast(own)
        if i == parts - 1:
            frame = frame.mapInArrow(_scanner(part, True), f"_row {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>")
        else:
            frame = stage(frame.mapInArrow(_scanner(part, False), f"_row {kind}, _text string, flags binary, items array<string>"), "scanned")
    return frame.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))
