"""Language identification of spans in mixed-language text.

Every word is scored against each language by hashed byte 4-grams with counts
learned from labelled text. The word's script, read from code-point ranges,
leaves only the languages whose training text uses that script. A Viterbi pass
over the words with a penalty for switching language then labels spans.

The learned table has languages x ``BUCKETS`` entries whatever the corpus's
size; counts are taken over all training text and combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens

GRAM = 4
BUCKETS = 1 << 15
SWITCH = 12.0  # penalty, in nats, for a change of language between two words
LEAST_SCRIPT = 0.01  # a language uses a script that so many of its words have
UNKNOWN = "und"

# First code points of script blocks, in ascending order, and
# the script that begins there ("" for none). Letters in a range of none, such
# as those of rarer scripts, have the script "Other".
SCRIPTS = (
    (0x41, "Latin"), (0x5B, ""), (0x61, "Latin"), (0x7B, ""), (0xAA, "Latin"), (0xAB, ""), (0xB5, "Latin"), (0xB6, ""),
    (0xBA, "Latin"), (0xBB, ""), (0xC0, "Latin"), (0xD7, ""), (0xD8, "Latin"), (0xF7, ""), (0xF8, "Latin"),
    (0x2B0, ""), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"),
    (0x700, "Syriac"), (0x750, "Arabic"), (0x780, "Thaana"), (0x7C0, "Nko"), (0x800, ""), (0x8A0, "Arabic"), (0x900, "Devanagari"),
    (0x980, "Bengali"), (0xA00, "Gurmukhi"), (0xA80, "Gujarati"), (0xB00, "Oriya"), (0xB80, "Tamil"), (0xC00, "Telugu"),
    (0xC80, "Kannada"), (0xD00, "Malayalam"), (0xD80, "Sinhala"), (0xE00, "Thai"), (0xE80, "Lao"), (0xF00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"),
    (0x1400, "Canadian"), (0x1680, ""), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Canadian"), (0x1900, ""),
    (0x1C90, "Georgian"), (0x1CC0, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""), (0x3040, "Kana"), (0x3100, ""),
    (0x3400, "Han"), (0x4DC0, ""), (0x4E00, "Han"), (0xA000, ""), (0xAC00, "Hangul"), (0xD7B0, ""),
    (0xF900, "Han"), (0xFB00, ""), (0x20000, "Han"), (0x323B0, ""),
)
OTHER = "Other"
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS} | {OTHER})  # index 0 is no script


def _scripts_of_points() -> np.ndarray:
    """Index of the script of every code point."""
    starts = [0, *(s for s, _ in SCRIPTS), 0x110000]
    out = np.repeat(np.array([0, *(SCRIPT_NAMES.index(name) for _, name in SCRIPTS)], np.uint8), np.diff(starts))
    none = np.flatnonzero(out == 0)
    letters = np.fromiter((chr(p).isalpha() for p in none.tolist()), bool, len(none))
    out[none[letters]] = SCRIPT_NAMES.index(OTHER)
    return out


_SCRIPT = _scripts_of_points()


def _word_scripts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the script of the first letter of each word, 0 if it has none."""
    b = data.astype(np.int32)
    pad = np.concatenate((b, np.zeros(3, np.int32)))
    lead = np.flatnonzero((b & 0xC0) != 0x80)
    first, b1, b2, b3 = b[lead], pad[lead + 1] & 0x3F, pad[lead + 2] & 0x3F, pad[lead + 3] & 0x3F
    point = np.select([first < 0x80, first < 0xE0, first < 0xF0],
                      [first, (first & 0x1F) << 6 | b1, (first & 0x0F) << 12 | b1 << 6 | b2],
                      (first & 0x07) << 18 | b1 << 12 | b2 << 6 | b3)
    script = _SCRIPT[point]
    letters = np.flatnonzero(script)
    where, script = lead[letters], script[letters]
    i = np.searchsorted(where, start)
    found = (i < len(where)) & (where[np.minimum(i, len(where) - 1)] < end) if len(where) else np.zeros(len(start), bool)
    out = np.zeros(len(start), np.int64)
    out[found] = script[i[found]]
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """Bucket of the byte 4-gram that begins at each byte; A-Z lower-cased, all
    kinds of white space alike."""
    low = tokens._LOWER[data]
    low = np.where(tokens._SPACE[low], 32, low).astype(np.uint32)
    pad = np.concatenate((low, np.full(GRAM, 32, np.uint32)))
    key = pad[:len(low)].copy()
    for i in range(1, GRAM):
        key = key << np.uint32(8) | pad[i:i + len(low)]
    key = (key ^ key >> np.uint32(15)) * np.uint32(0x9E3779B1)
    return (key >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, slot, n) per task: 4-gram buckets, then scripts after BUCKETS."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for b in tokens.blocks(batch.column(0)):
            own = np.array(langs[b.first:b.first + len(b.bounds) - 1])
            grams, scripts = _grams(b.data), _word_scripts(b.data, b.start, b.end)
            words, text_of = tokens.owners(b.bounds), np.repeat(np.arange(len(own)), np.diff(b.offsets))
            for lang in set(own.tolist()):
                total = sums.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                mine = own == lang
                total[:BUCKETS] += np.bincount(grams[mine[text_of]], minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(scripts[mine[words]], minlength=len(SCRIPT_NAMES))
    for lang, total in sums.items():
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(total[slot])], ["lang", "slot", "n"])


class Model(NamedTuple):
    langs: list[str]
    scores: np.ndarray  # BUCKETS x languages, log-probabilities
    allowed: np.ndarray  # scripts x languages


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count 4-grams and scripts by language over all rows whose text and
    language are not null. Without such rows the model knows no language."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = rows.mapInArrow(_counted, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    table[counts["slot"].to_numpy(), [langs.index(x) for x in counts["lang"]]] = counts["n"]
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    scores = np.log((grams + 0.1) / (grams.sum(0) + 0.1 * BUCKETS))
    scripts[0] = 0
    return Model(langs, scores.astype(np.float32), scripts >= LEAST_SCRIPT * np.maximum(scripts.sum(0), 1))


def word_scores(b: tokens.Block, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Score of each word in each language, at most 0 and best at 0, and which
    words have a letter. Words without a letter score 0 in all languages."""
    scripts = _word_scripts(b.data, b.start, b.end)
    lettered = scripts > 0
    out = np.zeros((len(b.start), len(model.langs)), np.float32)
    if len(b.start):
        grams = _grams(b.data)
        for k in range(len(model.langs)):
            sums = np.concatenate(([0], np.cumsum(model.scores[grams, k], dtype=np.float64)))
            out[:, k] = sums[b.end] - sums[b.start]
        allowed = model.allowed[scripts]
        known = allowed.any(1)  # a script that no language uses narrows nothing
        out[known] = np.where(allowed[known], out[known], -1e4)
        out -= out.max(1, keepdims=True)
        out[~lettered] = 0
    return out, lettered


def viterbi(scores: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Best language of every word of every text, a switch costing SWITCH.
    The texts of a block advance word by word together, the longest first."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = bounds[:-1][order], sizes[order]
    n, k = scores.shape
    back = np.zeros((n, k), np.uint8 if k <= 256 else np.int32)
    label = np.zeros(n, np.int64)
    if not n:
        return label
    stay = np.arange(k)
    best = scores[first[sizes > 0]].astype(np.float64)
    final = np.zeros(len(order), np.int64)
    live = len(best)
    for t in range(1, int(sizes[0]) + 1):
        now = int(np.searchsorted(-sizes, -t, "left"))  # texts of more than t words
        final[now:live] = best[now:live].argmax(1)
        best, live = best[:now], now
        if not now:
            break
        top = best.argmax(1)
        move = best.max(1) - SWITCH
        switch = best < move[:, None]
        at = first[:now] + t
        back[at] = np.where(switch, top[:, None], stay)
        best = np.where(switch, move[:, None], best) + scores[at]
    now = final
    for t in range(int(sizes[0]) - 1, -1, -1):
        live = int(np.searchsorted(-sizes, -t, "left"))
        at = first[:live] + t
        label[at] = now[:live]
        now[:live] = back[at, now[:live]]
    return label


_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _no_letter(text: bytes) -> bool:
    return not any(c.isalpha() for c in text.decode("utf-8", "replace"))


def identify(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``_row`` (a struct of the carried columns), lang, score and spans.

    ``lang`` has the most bytes of lettered words, ties going to the first by
    name, and ``score`` is its share of them. ``spans`` are the runs of one
    language with their character range. Text that is null or has no letter
    is ``und`` with score 0 and no spans; so is all text for a model without
    languages. Repeated rows get equal answers.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)])
    frame = docs.select(row.alias("_row"), F.col(text).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for b in tokens.blocks(batch.column(1)):
                n, k = len(b.bounds) - 1, len(m.langs)
                langs, shares, spans = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
                if k:
                    scores, lettered = word_scores(b, m)
                    label = viterbi(scores, b.bounds)
                    own = tokens.owners(b.bounds)
                    weight = np.where(lettered, b.end - b.start, 0)
                    mass = np.bincount(own * k + label, weight, n * k).reshape(n, k)
                    chars = np.concatenate(([0], np.cumsum((b.data & 0xC0) != 0x80)))
                    cut = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (own[1:] != own[:-1])))) if len(label) else label
                    ends = np.append(cut[1:], len(label)) - 1 if len(label) else label
                    zero = chars[b.offsets[own[cut]]] if len(label) else cut
                    for i, lang, s, e in zip(own[cut].tolist(), label[cut].tolist(), (chars[b.start[cut]] - zero).tolist(), (chars[b.end[ends]] - zero).tolist()):
                        spans[i].append({"lang": m.langs[lang], "start": s, "end": e})
                    best, total = mass.argmax(1), mass.sum(1)
                    for i in range(n):
                        if not total[i] and _no_letter(b.data[b.offsets[i]:b.offsets[i + 1]].tobytes()):
                            spans[i] = []
                        else:
                            langs[i], shares[i] = m.langs[best[i]], mass[i, best[i]] / max(total[i], 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.first, n), pa.array(langs, pa.string()), pa.array(shares), pa.array(spans, _SPANS)],
                    ["_row", "lang", "score", "spans"])

    return frame.mapInArrow(run, f"_row {frame.schema['_row'].dataType.simpleString()}, lang string, score double, spans array<struct<lang:string,start:int,end:int>>")
