"""Words and word hashes of whole Arrow text columns, in numpy.

A word is a maximal run of bytes other than space and U+0009-U+000D; letters
A-Z are lower-cased, every other character stays. Equal words get equal
64-bit hashes on every worker. Texts are handled in blocks of about
``BLOCK`` bytes, so memory stays bounded by the longest single text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = _powers(_BASE)
_INV = _powers(pow(_BASE, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Block(NamedTuple):
    """Words of the texts ``first`` to ``first + len(bounds) - 2`` of a column.

    ``bounds[i]:bounds[i + 1]`` are the words of text i of the block; ``start``
    and ``end`` are byte positions in ``data``, the texts' bytes as they are,
    where text i begins at ``offsets[i]``.
    """

    first: int
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, limit: int = 4 * BLOCK) -> Iterator[Block]:
    """Split a text column into blocks of whole texts with their words."""
    if not len(column):
        return
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        own = data[offsets[first]:offsets[last]]
        at = offsets[first:last + 1] - offsets[first]
        space = _SPACE[own]
        before = np.ones(len(own) + 1, bool)
        before[1:] = space
        before[at] = True
        start = np.flatnonzero(before[:-1] & ~space)
        after = np.ones(len(own) + 1, bool)
        after[:-1] = space
        after[at] = True
        end = np.flatnonzero(after[1:] & ~space) + 1
        yield Block(first, own, at, start, end, np.searchsorted(start, at))
        first = last


def word_hashes(block: Block, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word of the block."""
    start, end, n = block.start, block.end, len(block.start)
    out, i = np.empty(n, np.uint64), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        own = block.data[lo:hi]
        own = _LOWER[own] if lower else own
        if hi - lo > BLOCK:  # one word longer than a block
            out[i] = int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little")
        else:
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((own.astype(np.uint64) + np.uint64(1)) * _POW[:hi - lo], out=sums[1:])
            s, e = start[i:j] - lo, end[i:j] - lo
            out[i:j] = mix((sums[e] - sums[s]) * _INV[s])
        i = j
    return out


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each word, the index of its text within the block."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def windows(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every window of ``k`` words inside one text."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(hashes) - k + 1
    joint = np.zeros(n, np.uint64)
    for i in range(k):
        joint = joint * np.uint64(0xD6E8FEB86659FD93) + hashes[i:i + n]
    last = np.repeat(bounds[1:], np.diff(bounds))[:n]
    at = np.flatnonzero(np.arange(n) + k <= last)
    return mix(joint[at]), at


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every k-word shingle; a text of fewer words, but at
    least one, is one shingle as a whole."""
    joint, at = windows(hashes, bounds, k)
    own = owners(bounds)[at]
    sizes = np.diff(bounds)
    parts, texts = [joint], [own]
    for c in range(1, k):
        short = np.flatnonzero(sizes == c)
        if len(short):
            h = np.full(len(short), c, np.uint64)
            for i in range(c):
                h = h * np.uint64(0xD6E8FEB86659FD93) + hashes[bounds[short] + i]
            parts.append(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            texts.append(short)
    return np.concatenate(parts), np.concatenate(texts)
