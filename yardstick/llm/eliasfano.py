"""Elias-Fano coding of sorted integers as NumPy arrays that can be memory-mapped, with vectorised successor search."""

from __future__ import annotations

import json

import numpy as np

U = np.uint64


def _or_runs(word: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """OR the values of equal word numbers (sorted) into an array of `size` words."""
    out = np.zeros(size, U)
    if len(word):
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[starts]] = np.bitwise_or.reduceat(value, starts)
    return out


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    size = (n * width + 63) // 64 + 1
    if not width or not n:
        return np.zeros(size, U)
    bit = np.arange(n, dtype=np.int64) * width
    word, off = bit >> 6, (bit & 63).astype(U)
    out = _or_runs(word, values << off, size)
    over = (off + U(width)) > U(64)
    out |= _or_runs(word[over] + 1, values[over] >> (U(64) - off[over]), size)
    return out


def unpack_at(words: np.ndarray, width: int, i: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(i), U)
    bit = i * width
    word, off = bit >> 6, (bit & 63).astype(U)
    low = words[word] >> off
    high = np.where(off > 0, words[word + 1] << ((U(64) - off) & U(63)), U(0))
    return (low | high) & U((1 << width) - 1)


def _select_bit(w: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th (from 1) set bit of every word."""
    place = np.zeros(len(w), np.int64)
    r = r.copy()
    for half in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(w & U((1 << half) - 1)).astype(np.int64)
        up = r > low
        r -= np.where(up, low, 0)
        w = np.where(up, w >> U(half), w)
        place += np.where(up, half, 0)
    return place


def encode(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """Arrays of a non-decreasing uint64 sequence."""
    n = len(values)
    first = values[0] if n else U(0)
    v = values - first
    top = int(v[-1]) if n else 0
    width = max(0, (max(1, top) // max(1, n)).bit_length() - 1)
    high = (v >> U(width)).astype(np.int64) + np.arange(n)
    size = ((int(high[-1]) + 2 if n else 1) + 63) // 64 + 1
    bits = _or_runs(high >> 6, U(1) << (high & 63).astype(U), size)
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])
    return {f"{name}.head": np.array([n, int(first), width, top], U), f"{name}.low": pack_bits(v & U((1 << width) - 1), width),
            f"{name}.bits": bits, f"{name}.ones": before[:-1].astype(np.uint32)}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        head, self.low, self.bits, ones = (arrays[f"{name}.{k}"] for k in ("head", "low", "bits", "ones"))
        self.n, self.first, self.width, self.top = int(head[0]), U(head[1]), int(head[2]), U(head[3])
        self.ones = ones.astype(np.int64)
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - self.ones

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at places i."""
        word = np.searchsorted(self.ones, i, "right") - 1
        at = _select_bit(np.asarray(self.bits[word]), i - self.ones[word] + 1) + word * 64
        return ((at - i).astype(U) << U(self.width) | unpack_at(self.low, self.width, i)) + self.first

    def _zero(self, r: np.ndarray) -> np.ndarray:
        """Place of the r-th (from 1) zero of the high bits."""
        word = np.maximum(np.searchsorted(self.zeros, r, "left") - 1, 0)
        return _select_bit(~np.asarray(self.bits[word]), r - self.zeros[word]) + word * 64

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of every x, or -1: select finds the bucket of its high bits, binary search its successor there."""
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        y = x - self.first
        todo = np.flatnonzero((x >= self.first) & (y <= self.top))
        y = y[todo]
        high = (y >> U(self.width)).astype(np.int64)
        want = y & U((1 << self.width) - 1)
        lo = np.where(high > 0, self._zero(np.maximum(high, 1)) + 1 - high, 0)
        end = self._zero(high + 1) - high
        hi = end.copy()
        active = np.flatnonzero(lo < hi)
        while len(active):
            mid = (lo[active] + hi[active]) >> 1
            less = unpack_at(self.low, self.width, mid) < want[active]
            lo[active] = np.where(less, mid + 1, lo[active])
            hi[active] = np.where(less, hi[active], mid)
            active = active[lo[active] < hi[active]]
        some = np.flatnonzero(lo < end)
        some = some[unpack_at(self.low, self.width, lo[some]) == want[some]]
        out[todo[some]] = lo[some]
        return out


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """One file: length of the header, header, arrays aligned to 8 bytes."""
    head, at, parts = {}, 0, []
    for k, a in arrays.items():
        raw = a.tobytes()
        head[k] = [a.dtype.str, at, len(a)]
        parts.append(raw + b"\0" * (-len(raw) % 8))
        at += len(parts[-1])
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(parts)


def from_buffer(buffer) -> dict[str, np.ndarray]:
    n = int.from_bytes(bytes(buffer[:8]), "little")
    head = json.loads(bytes(buffer[8:8 + n]))
    return {k: np.frombuffer(buffer, dtype, count, 8 + n + at) for k, (dtype, at, count) in head.items()}
