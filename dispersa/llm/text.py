"""Byte-level helpers for Arrow tasks: row slices of bounded size, word spans, fingerprints.

Everything works on the UTF-8 bytes of a slice of rows, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from dispersa.llm.shared import per_worker

U64 = np.uint64
SLICE_BYTES = 1 << 16  # an array of 64-bit numbers fits a core's cache; all of a slice take some 100 times its bytes
TEXT_BYTES = 1 << 18  # of a slice whose rows are worked on one by one

# White space that ends a word: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z to a-z on bytes; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # of the shingles: few names long
# Fingerprints: two primes below 2**31 with a base each, so products fit 64 bits.
_PRIMES = (2147483647, 2147483629)
_BASES = (1664525013, 1013904243)
_CODES = [np.random.default_rng(20240229 + i).integers(1, p, 256, dtype=np.int64).astype(U64) for i, p in enumerate(_PRIMES)]


class Slice(NamedTuple):
    """Rows [first, first + rows) of a batch: their bytes one after the other, and row bounds."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Row ranges of a string column with at most ``limit`` bytes (or a single longer row).
    NULL is an empty text."""
    if len(column) == 0:
        return
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        yield Slice(i, raw[bounds[i]: bounds[j]], bounds[i: j + 1] - bounds[i])
        i = j


def row_of(bounds: np.ndarray, n: int | None = None) -> np.ndarray:
    """Row number of each byte (or other unit) counted by ``bounds``."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(n: int, base: int, prime: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) modulo the prime, by doubling."""
    out = np.ones(max(1, n), U64)
    done, step = 1, base % prime
    while done < n:
        more = min(done, n - done)
        out[done: done + more] = out[:more] * U64(step) % U64(prime)
        done, step = done + more, step * step % prime
    return out


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of the bases and of their inverses, kept by the Python worker for the usual lengths."""
    make = lambda size: [(_powers(size, b, p), _powers(size, pow(b, -1, p), p)) for b, p in zip(_BASES, _PRIMES)]
    if n <= TEXT_BYTES + 1:
        return per_worker("fingerprint powers", lambda: make(TEXT_BYTES + 1))
    return make(n)


def _modulo(x: np.ndarray, prime: int) -> np.ndarray:
    """``x % prime`` in half the time: numpy divides by a constant in vectors, but takes remainders one by one."""
    out = x // U64(prime)
    out *= U64(prime)
    return np.subtract(x, out, out=out)


class Fingerprints:
    """62-bit names of any substrings of ``data`` in constant time each: polynomial prefix sums over random
    byte codes, modulo two primes. Equal strings have equal names wherever they stand; two different ones of n
    bytes agree with a chance of about (n / 2**31) ** 2. ``data`` of 64-bit names (of words) stands for itself."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums, self.back = [], []
        for codes, prime, (powers, back) in zip(_CODES, _PRIMES, _tables(n + 1)):
            sums = np.zeros(n + 1, U64)  # below n * 2**31, so not reduced
            code = codes[data] if data.dtype == np.uint8 else _modulo(data, prime)
            code *= powers[:n]
            np.cumsum(_modulo(code, prime), out=sums[1:])
            self.sums.append(sums)
            self.back.append(back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        a, b = (_modulo(_modulo(s[end] - s[start], p) * back[start], p) for s, back, p in zip(self.sums, self.back, _PRIMES))
        return mix((a | b << U64(32)) + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))

    def every(self, length: int) -> np.ndarray:
        """Names of the substrings of ``length`` bytes at all positions."""
        n = len(self.sums[0]) - length
        if n <= 0:
            return np.zeros(0, U64)
        a, b = (_modulo(_modulo(s[length:] - s[:n], p) * back[:n], p) for s, back, p in zip(self.sums, self.back, _PRIMES))
        return mix(a | b << U64(32))

    def hashes(self, length: int) -> np.ndarray:
        """Hashes of the substrings of ``length`` bytes at all positions, by one prime: for places, not for names."""
        s, back, p = self.sums[0], self.back[0], _PRIMES[0]
        n = len(s) - length
        return mix(_modulo(_modulo(s[length:] - s[:n], p) * back[:n], p)) if n > 0 else np.zeros(0, U64)


def spans(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``inside`` set that do not cross row bounds.
    Returns their starts, ends and the number of runs before each row."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(bounds), np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = bounds[:-1][np.diff(bounds) > 0]
    begin[cut] = inside[cut]
    starts = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    last = bounds[1:][np.diff(bounds) > 0] - 1
    stop[last] = inside[last]
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, bounds, "left")


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` as (starts, ends, words before each row)."""
    return spans(data, bounds, ~SPACE[data])


def shingles(names: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all runs of ``width`` consecutive words of a row, with each run's row; a row of
    fewer words, but not none, gives its whole sequence as one."""
    counts = np.diff(before)
    n = len(names)
    rows = np.repeat(np.arange(len(counts)), counts)
    whole = max(0, n - width + 1)
    acc = np.zeros(whole, U64)
    for k in range(width):
        acc = acc * U64(_BASE) + names[k: k + whole]
    ok = rows[:whole] == rows[width - 1: width - 1 + whole] if whole else np.zeros(0, bool)
    out, out_rows = mix(acc[ok] + U64(width)), rows[:whole][ok]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.empty(len(short), U64)
        for i, r in enumerate(short):
            a = 0
            for x in names[before[r]: before[r + 1]].tolist():
                a = (a * _BASE + x) & 0xFFFFFFFFFFFFFFFF
            extra[i] = (a + int(counts[r])) & 0xFFFFFFFFFFFFFFFF
        out = np.concatenate([out, mix(extra)])
        out_rows = np.concatenate([out_rows, short])
        order = np.argsort(out_rows, kind="stable")
        out, out_rows = out[order], out_rows[order]
    return out, out_rows
