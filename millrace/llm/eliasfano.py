"""Elias-Fano sequences over memory-mapped arrays, with vectorised access and successor search."""

from __future__ import annotations

import json
from functools import cached_property

import numpy as np

U = np.uint64
_ONE = U(1)
_IN_BYTE = np.array([[([i for i in range(8) if x >> i & 1] + [0] * 8)[r] for r in range(8)] for x in range(256)], np.int64)


class EliasFano:
    """A non-decreasing sequence of 64-bit numbers: low bits packed, high parts in unary.

    ``arrays`` holds them by name, so that a file of named arrays can be mapped.
    """

    def __init__(self, arrays: dict, n: int, low_bits: int):
        self.n, self.l = n, low_bits
        self.low, self.high, self.ones = arrays["low"], arrays["high"], arrays["ones"]

    @cached_property
    def zeros(self) -> np.ndarray:
        return np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    @staticmethod
    def build(values: np.ndarray) -> tuple[dict, int, int]:
        """(arrays, n, low bits) of a sorted array."""
        v = np.asarray(values, U)
        n = len(v)
        top = int(v[-1]) + 1 if n else 1
        l = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (v >> U(l)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 1
        bits = np.zeros((size + 63) // 64 * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(U)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        packed = np.zeros((n * l + 63) // 64 + 1, U)
        if l and n:
            low = v & U((1 << l) - 1)
            at = np.arange(n, dtype=np.int64) * l
            word, shift = at >> 6, (at & 63).astype(U)
            # Numbers that begin in one word are or-ed together; their spill goes to the next.
            begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            packed[word[begins]] = np.bitwise_or.reduceat(low << shift, begins)
            spill = np.flatnonzero(shift.astype(np.int64) + l > 64)
            packed[word[spill] + 1] |= low[spill] >> (U(64) - shift[spill])
        return {"low": packed, "high": words, "ones": ones}, n, l

    def _low(self, i: np.ndarray) -> np.ndarray:
        if self.l == 0:
            return np.zeros(len(i), U)
        at = i * self.l
        word, shift = at >> 6, (at & 63).astype(U)
        x = self.low[word] >> shift
        over = shift.astype(np.int64) + self.l > 64
        x = np.where(over, x | (self.low[word + over] << ((U(64) - shift) & U(63))), x)
        return x & U((1 << self.l) - 1)

    @staticmethod
    def _in_word(w: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Position of the r-th (from 0) one bit of each word: byte by prefix counts, then a table."""
        with np.errstate(over="ignore"):
            b = w - ((w >> _ONE) & U(0x5555555555555555))
            b = (b & U(0x3333333333333333)) + ((b >> U(2)) & U(0x3333333333333333))
            b = ((b + (b >> U(4))) & U(0x0F0F0F0F0F0F0F0F)) * U(0x0101010101010101)
            r = r.astype(U)
            full = (((r * U(0x0101010101010101)) | U(0x8080808080808080)) - b) & U(0x8080808080808080)
        shift = np.bitwise_count(full).astype(U) * U(8)
        r = r - (((b << U(8)) >> shift) & U(0xFF))
        return shift.astype(np.int64) + _IN_BYTE[((w >> shift) & U(0xFF)).astype(np.intp), r.astype(np.intp) & 7]

    def _select(self, i: np.ndarray, zero: bool) -> np.ndarray:
        counts = self.zeros if zero else self.ones
        w = np.searchsorted(counts, i, "right") - 1
        word = self.high[w]
        return w * 64 + self._in_word(~word if zero else word, i - counts[w])

    def _run(self, p: np.ndarray) -> np.ndarray:
        """How many one bits follow from position p on; 64 stands for 64 or more."""
        word, shift = p >> 6, (p & 63).astype(U)
        x = self.high[np.minimum(word, len(self.high) - 1)] >> shift
        after = self.high[np.minimum(word + 1, len(self.high) - 1)]
        x = np.where(shift > 0, x | (after << ((U(64) - shift) & U(63))), x)
        with np.errstate(over="ignore"):
            return np.bitwise_count(x & ~(x + _ONE)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at the positions."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, U)
        return ((self._select(i, False) - i).astype(U) << U(self.l)) | self._low(i)

    def pair(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at the positions and at those after them."""
        if not len(i):
            return np.zeros(0, U), np.zeros(0, U)
        p = self._select(i, False)
        word, shift = (p + 1) >> 6, ((p + 1) & 63).astype(U)
        x = self.high[np.minimum(word, len(self.high) - 1)] >> shift
        after = self.high[np.minimum(word + 1, len(self.high) - 1)]
        x = np.where(shift > 0, x | (after << ((U(64) - shift) & U(63))), x)
        with np.errstate(over="ignore"):
            q = p + 1 + np.bitwise_count(~x & (x - _ONE)).astype(np.int64)
        far = np.flatnonzero(x == 0)
        if len(far):
            q[far] = self._select(i[far] + 1, False)
        l = U(self.l)
        return ((p - i).astype(U) << l) | self._low(i), ((q - i - 1).astype(U) << l) | self._low(i + 1)

    def find(self, x: np.ndarray, lo=None, hi=None) -> np.ndarray:
        """Positions of x within [lo, hi) by successor search; -1 where absent."""
        x = np.asarray(x, U)
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        h = (x >> U(self.l)).astype(np.int64)
        last = int(self.zeros[-1]) - 1
        ok = np.flatnonzero((h >= 0) & (h <= last))
        h = h[ok]
        begin = np.where(h > 0, self._select(np.maximum(h - 1, 0), True) + 1, 0)
        a, run = begin - h, self._run(begin)
        b = a + run
        wide = np.flatnonzero(run >= 64)
        if len(wide):
            b[wide] = self._select(h[wide], True) - h[wide]
        b = np.minimum(b, self.n)
        if lo is not None:
            a, b = np.maximum(a, lo[ok]), np.minimum(b, hi[ok])
        want = x[ok] & U((1 << self.l) - 1)
        end = b.copy()
        while True:
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                break
            mid = (a[open_] + b[open_]) >> 1
            less = self._low(mid) < want[open_]
            a[open_] = np.where(less, mid + 1, a[open_])
            b[open_] = np.where(less, b[open_], mid)
        inside = np.flatnonzero(a < end)
        hit = inside[self._low(a[inside]) == want[inside]]
        out[ok[hit]] = a[hit]
        return out


def pack(arrays: dict[str, np.ndarray], meta: dict) -> bytes:
    """One file of named arrays: length of the header, header (JSON), arrays at multiples of 64 bytes."""
    entries, at, parts = {}, 0, []
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        entries[name] = (a.dtype.str, len(a), at)
        raw = a.tobytes()
        raw += bytes(-len(raw) % 64)
        parts.append(raw)
        at += len(raw)
    head = json.dumps({"meta": meta, "arrays": entries}).encode()
    head += b" " * (-(len(head) + 8) % 64)
    return len(head).to_bytes(8, "little") + head + b"".join(parts)


def mapped(path: str) -> tuple[dict[str, np.ndarray], dict]:
    """The arrays of a file, mapped read-only, and its meta data."""
    raw = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8 : 8 + size].tobytes())
    base = 8 + size
    arrays = {}
    for name, (kind, n, at) in head["arrays"].items():
        dtype = np.dtype(kind)
        arrays[name] = raw[base + at : base + at + n * dtype.itemsize].view(dtype)
    return arrays, head["meta"]


def named(prefix: str, built: tuple[dict, int, int], arrays: dict, meta: dict) -> None:
    """Add a built sequence to the arrays and meta data of a file."""
    parts, n, l = built
    arrays.update({f"{prefix}.{k}": v for k, v in parts.items()})
    meta[prefix] = [n, l]


def opened(prefix: str, arrays: dict, meta: dict) -> EliasFano:
    n, l = meta[prefix]
    return EliasFano({k: arrays[f"{prefix}.{k}"] for k in ("low", "high", "ones")}, n, l)
