"""Word hashes of whole texts, vectorised over the bytes of an Arrow batch (NumPy, no loop over words).

A word is a maximal run of bytes other than space and 0x09-0x0D; a word never spans two texts.
Its hash is a polynomial in an odd base modulo 2**64, mixed with its length, so it depends on
the word's bytes alone and is the same in every task.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15  # odd: invertible modulo 2**64
CHUNK = 1 << 20

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_SAME = np.arange(256, dtype=np.uint64) + 1
_LOWER = _SAME.copy()
_LOWER[65:91] += 32
_tables: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hashes."""
    return mix(a * np.uint64(0x9FB21C651E98DF25) + (b ^ np.uint64(0xD6E8FEB86659FD93)))


def _powers(n: int) -> list[np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        up = np.full(max(n, CHUNK), BASE, np.uint64)
        down = np.full(max(n, CHUNK), pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _tables[:] = [np.cumprod(up), np.cumprod(down)]
    return _tables


class Words(NamedTuple):
    hash: np.ndarray  # uint64, one per word
    first: np.ndarray  # int64, texts + 1: the words of text i are hash[first[i]:first[i + 1]]


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes and offsets (texts + 1, from 0); a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def words(texts: pa.Array, lower: bool = True) -> Words:
    raw, at = raw_bytes(texts)
    sep = _SEP[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True  # a text's first byte, and the end
    before = np.ones(len(raw), bool)
    before[1:] = sep[:-1]
    after = np.ones(len(raw), bool)
    after[:-1] = sep[1:]
    start = np.flatnonzero(~sep & (before | edge[:-1]))
    stop = np.flatnonzero(~sep & (after | edge[1:])) + 1
    first = np.searchsorted(start, at)
    out = np.empty(len(start), np.uint64)
    value = _LOWER if lower else _SAME
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(stop, start[i] + CHUNK, "right")))
        lo, hi = start[i], stop[j - 1]
        up, down = _powers(int(hi - lo) + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(value[raw[lo:hi]] * up[:hi - lo], out=total[1:])
        s, e = start[i:j] - lo, stop[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        i = j
    return Words(mix(out), first)


def by_bytes(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Slices of the batch with at most `most` bytes of text each (a longer text is a slice of its own)."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def distinct_by_text(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of each text, and their offsets."""
    parts, sizes = [], np.zeros(len(first) - 1, np.int64)
    for i in range(len(first) - 1):
        got = np.unique(keys[first[i]:first[i + 1]])
        parts.append(got)
        sizes[i] = len(got)
    at = np.concatenate([[0], np.cumsum(sizes)])
    return (np.concatenate(parts) if parts else keys[:0]), at


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashed n-word shingles of each text; fewer words are one shingle, no words none."""
    h, first = w
    counts = np.diff(first)
    m = max(0, len(h) - n + 1)
    runs = h[:m].copy()
    for k in range(1, n):
        runs = pair(runs, h[k:k + m])
    parts, sizes = [], np.zeros(len(counts), np.int64)
    for i, c in enumerate(counts):
        a = first[i]
        if c >= n:
            got = np.unique(runs[a:a + c - n + 1])
        elif c:
            whole = h[a:a + 1]
            for k in range(1, c):
                whole = pair(whole, h[a + k:a + k + 1])
            got = mix(whole + np.uint64(c))
        else:
            got = h[:0]
        parts.append(got)
        sizes[i] = len(got)
    return (np.concatenate(parts) if parts else h[:0]), np.concatenate([[0], np.cumsum(sizes)])
