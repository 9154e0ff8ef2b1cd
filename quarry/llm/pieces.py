"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The vocabulary is a byte-fallback BPE model. Its segmentation of a text is the
one path in the lattice of pieces on which every two neighbours are what the
merges make of their concatenation; a path's score is 0 if that holds for all
of its steps and minus infinity otherwise. The pass keeps, for each boundary
of the last ``longest`` characters (the maximum piece length), the surviving
piece that ends there and its backpointer, and commits ids as soon as all
surviving paths lead back to one boundary. No piece holds a word start after
another character, and a character outside the vocabulary (such as a line
break) is spelt in bytes and merges with nothing, so paths always converge at
word starts and at such characters: words are looked up in a bounded cache and
only new ones are passed through the lattice.

The vocabulary file's path is a parameter; the file is read on the driver and
its fixed-size content is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"  # how pieces spell a space
CACHE = 300_000
COMMIT_EVERY = 64


class Recent(dict):
    """A cache of two generations of at most ``CACHE`` entries each."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Pieces:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        special = {i for i in range(size) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)}
        self.ids = {sp.id_to_piece(i): i for i in range(size) if i not in special}
        self.rank = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in special if sp.is_byte(i)}
        self.longest = max(map(len, self.ids))
        self.size = [len(sp.id_to_piece(i)) for i in range(size)]
        self.piece = [sp.id_to_piece(i) for i in range(size)]
        self.trie = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.trie.add_word(p, (len(p), i))
        self.trie.make_automaton()
        self.alien = re.compile("[^" + "".join(re.escape(p) for p in self.ids if len(p) == 1) + "]").search
        self.spelt = [b"" if i in special else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        for b, i in self.bytes.items():
            self.spelt[i] = bytes([b])
        self.split = re.compile(self._parts()).findall
        self.halves = Recent(lambda piece: self._merged(piece)[1])
        self.agrees = Recent(self._agrees)
        self.word = Recent(lambda w: np.array(self._ids(w), np.int32).tobytes())

    def _parts(self) -> str:
        """Pattern of parts between which no piece can lie: they end before a
        word start, at line breaks unless these are pieces, and before a mark
        that no piece holds after anything but marks and spaces."""
        pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        marks = {c for p in self.ids for c in p if not c.isalpha() and not c.isdecimal() and c != SPACE}
        while crossed := {b for a, b in pairs if b in marks and a not in marks and a != SPACE}:
            marks -= crossed
        m = "".join(re.escape(c) for c in sorted(marks) if c < "\x80")
        line = "" if "\n" in self.ids else "\n"
        return "|".join(([f"{SPACE}*[{m}]+[^{SPACE}{line}{m}]*"] if m else []) + [f"{SPACE}+[^{SPACE}{line}{m}]*"] + ([f"{line}+"] if line else []) + [f"[^{SPACE}{line}{m}]+"])

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """What the merges make of a short text, best-ranked neighbours first
        and from the left among equals; and the last two that were merged."""
        parts, pair = list(text), None
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts, pair
            pair = parts[at], parts[at + 1]
            parts[at:at + 2] = ["".join(pair)]

    def _agrees(self, pair: int) -> bool:
        """Whether the merges leave both pieces of a pair as they are.

        Undoes the later merge of the two again and again: had the neighbours
        at the boundary been merged before it, the pieces would not exist.
        Runs of spaces share one rank, so their merges are carried out."""
        a, b = (self.piece[i] for i in divmod(pair, len(self.piece)))
        if SPACE * 2 in a or SPACE * 2 in b or a == SPACE and b == SPACE:
            return self._merged(a + b)[0] == [a, b]
        limit = float("inf")
        while True:
            joint = self.rank.get(a + b)
            if joint is not None and joint < limit:
                return False
            made_a, made_b = self.rank[a] if len(a) > 1 else -1, self.rank[b] if len(b) > 1 else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                limit, a = made_a, self.halves[a][1]
            else:
                limit, b = made_b + 0.5, self.halves[b][0]  # an equal rank further left goes first

    def _ids(self, text: str) -> list[int]:
        """Ids of a part of a text; characters that are no piece are spelt in
        bytes."""
        if not self.alien(text):
            return self._stream(text)
        out: list[int] = []
        known = ""
        for c in text:
            if c in self.ids:
                known += c
            else:
                out += self._stream(known) + [self.bytes[b] for b in c.encode("utf-8", "surrogatepass")]
                known = ""
        return out + self._stream(known)

    def _stream(self, text: str) -> list[int]:
        """Ids of a text of known characters, spaces spelt as pieces do. The
        automaton names the pieces that end at each character, longest first;
        ``last[k]`` is the surviving one that ends k characters after the
        boundary up to which ids are committed."""
        size, agrees, total = self.size, self.agrees, len(self.size)
        out: list[int] = []
        last, done = [-1], 0
        for at, (length, i) in self.trie.iter(text):
            end = at + 1 - done
            if end < len(last) or end < length:
                continue
            before = last[end - length]
            if before >= 0 and not agrees[before * total + i]:
                continue
            last.append(i)
            if end >= COMMIT_EVERY:
                heads = set(range(end - self.longest + 1, end + 1))
                while len(heads) > 1:  # follow backpointers until all paths meet
                    top = max(heads)
                    heads.discard(top)
                    heads.add(top - size[last[top]] if top > 0 else 0)
                goal = heads.pop()
                out += self._path(last, goal)
                last = last[goal:]
                done += goal
        return out + self._path(last, len(last) - 1)

    def _path(self, last: list[int], at: int) -> list[int]:
        path = []
        while at > 0:
            path.append(last[at])
            at -= self.size[last[at]]
        return path[::-1]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; null and empty texts have none."""
        if not text:
            return np.zeros(0, np.int32)
        return np.frombuffer(b"".join(map(self.word.__getitem__, self.split(SPACE + text.replace(" ", SPACE)))), np.int32)

    def decode(self, ids) -> str:
        """The text of ids, without the space that encoding puts first. Bytes
        that are not UTF-8 become replacement characters; control ids nothing."""
        return b"".join(map(self.spelt.__getitem__, ids)).decode("utf-8", "replace")[1:]


_loaded: list = []


def _pieces(model: Broadcast) -> Pieces:
    if not _loaded or _loaded[0] is not model.value:
        _loaded[:] = [model.value, Pieces(model.value)]
    return _loaded[1]


def _broadcast(frame: DataFrame, path: str) -> Broadcast:
    with open(path, "rb") as f:
        return frame.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``_row`` (a struct of the carried columns), ids, n_tokens, and
    round_trip: whether decoding the ids gives the text back (the vocabulary
    cannot tell U+2581 from a space). A null or empty text has no ids and
    round-trips as empty. Repeated rows get equal answers."""
    model = _broadcast(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = rows.column("_text").to_pylist()
                ids = [p.encode(t) for t in texts]
                sizes = [len(x) for x in ids]
                same = [p.decode(x.tolist()) == (t or "") for x, t in zip(ids, texts)]
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_row"), lists, pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())],
                    ["_row", "ids", "n_tokens", "round_trip"])

    row = F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)])
    frame = docs.select(row.alias("_row"), F.col(text).alias("_text"))
    return frame.mapInArrow(run, f"_row {frame.schema['_row'].dataType.simpleString()}, ids array<int>, n_tokens long, round_trip boolean")


def decode(frame: DataFrame, path: str, ids: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """``_row`` and text for rows of ids; null ids give a null text, an id
    outside the vocabulary fails the job."""
    model = _broadcast(frame, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pieces(model)
        for batch in batches:
            texts = [None if x is None else p.decode(x) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())], ["_row", "text"])

    row = F.struct(*[F.col(f"`{c}`") for c in (carry or frame.columns)])
    source = frame.select(row.alias("_row"), F.col(ids).alias("_ids"))
    return source.mapInArrow(run, f"_row {source.schema['_row'].dataType.simpleString()}, text string")
