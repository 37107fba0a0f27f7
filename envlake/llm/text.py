"""Splitting whole Arrow batches of texts into words with a few numpy passes.

Two kinds of words, both over UTF-8 bytes after lower-casing A-Z alone:

* ALNUM: runs of 0-9, a-z and every byte of a code point above 0x7F;
* BLACK: runs of anything but space and 0x09-0x0D.

Separators are single ASCII bytes, so bytes and code points give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
BLACK = np.ones(256, bool)
BLACK[[32, 9, 10, 11, 12, 13]] = False
#: Regular expressions of the same words, for Spark's and DuckDB's functions.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLACK_WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Words:
    """Words of some texts: the bytes of all, one after the other, and where each starts."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int32, one more than words
    first: np.ndarray  # int64: the first word of each text, and the number of words

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def arrow(self) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(self), [None, pa.py_buffer(self.offsets), pa.py_buffer(np.ascontiguousarray(self.data))])

    def strings(self) -> pa.Array:
        return pa.Array.from_buffers(pa.string(), len(self), [None, pa.py_buffer(self.offsets), pa.py_buffer(np.ascontiguousarray(self.data))])


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split_words(texts: pa.Array, kind: np.ndarray = ALNUM) -> Words:
    data, at = raw_bytes(texts)
    low = LOWER[data]
    inside = kind[low]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = at[1:-1]
    edge = edge[(edge > 0) & (edge < len(low))]
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(start)
    lengths = np.flatnonzero(end) + 1 - starts
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return Words(low[inside], offsets, np.searchsorted(starts, at))


_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: it has an inverse modulo 2**64
_POWERS = np.ones(1, np.uint64)
#: Bytes of a word that is hashed column by column, at most; bytes of longer words that are hashed together.
SHORT_WORD, STRETCH = 24, 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    while len(_POWERS) < n:
        _POWERS = np.concatenate([_POWERS, _POWERS * np.uint64(pow(int(_BASE), len(_POWERS), 2**64))])
    return _POWERS[:n]


_SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def hash_words(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every task."""
    starts, ends = words.offsets[:-1].astype(np.int64), words.offsets[1:].astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64)
    # the sum over i of spread(byte i) * base**i: column by column where words are short
    out, length = np.zeros(len(starts), np.uint64), ends - starts
    order = np.argsort(-length, kind="stable")
    long = int(np.searchsorted(-length[order], -SHORT_WORD, side="left"))
    if long:
        out[order[:long]] = _long_sums(words.data, starts[order[:long]], length[order[:long]])
    order = order[long:]
    by_length, total = starts[order], np.zeros(len(order), np.uint64)
    if len(order):
        longest = int(length[order[0]])
        powers = _powers(longest)
        counts = np.searchsorted(-length[order], -np.arange(longest), side="left")
        for i in range(longest):
            n = counts[i]
            total[:n] += _SPREAD[words.data[by_length[:n] + i]] * powers[i]
        out[order] = total
    return mix(out ^ (ends - starts).astype(np.uint64))


def _long_sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same sums of words of any length, some bytes at a time."""
    out, base = np.zeros(len(starts), np.uint64), int(_BASE)
    group = np.cumsum(lengths) // STRETCH
    for g in np.unique(group):
        own = np.flatnonzero(group == g)
        if lengths[own].max() <= STRETCH:
            n = lengths[own]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[own] = np.add.reduceat(_SPREAD[data[np.repeat(starts[own], n) + within]] * _powers(int(n.max()))[within], np.cumsum(n) - n)
            continue
        for i in own:
            for at in range(0, int(lengths[i]), STRETCH):
                part = data[starts[i] + at : starts[i] + min(at + STRETCH, int(lengths[i]))]
                out[i] = (int(out[i]) + int((_SPREAD[part] * _powers(len(part))).sum()) * pow(base, at, 2**64)) % 2**64
    return out


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + n])
    return out


def pieces(texts: pa.Array, limit: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about limit bytes of text each; a longer text stands alone."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield first, i
            first, total = i, 0
        total += int(n)
    if first < len(sizes):
        yield first, len(sizes)
