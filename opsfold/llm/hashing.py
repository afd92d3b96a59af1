"""Vectorised 64-bit hashing of byte ranges and words, used inside Arrow tasks.

A buffer of bytes gets one prefix polynomial over random byte values; the hash
of any range then costs one subtraction and one multiplication, whatever its
length, and does not depend on where the range lies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = b" \t\n\x0b\x0c\r"
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else 2 * len(have))
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 1 << 21:  # 16 MB
            _powers[base] = have
    return have[:n]


def _byte_values(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(
        0, 1 << 64, size=256, dtype=U64, endpoint=False)


class RangeHash:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray, seed: int = 1):
        n = len(buf)
        self.prefix = np.zeros(n + 1, dtype=U64)
        terms = _byte_values(seed)[buf]
        terms *= _power(BASE, n)
        np.cumsum(terms, out=self.prefix[1:])
        self.inverse = _power(INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = self.prefix[end] - self.prefix[start]
        raw *= self.inverse[start]
        return mix(raw + (end - start).astype(U64))

    def grams(self, width: int) -> np.ndarray:
        """Hash of every range of ``width`` bytes, by start."""
        n = max(0, len(self.prefix) - width)
        raw = self.prefix[width:width + n] - self.prefix[:n]
        raw *= self.inverse[:n]
        return mix(raw)


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a newline after each part, and the start of each part."""
    buf = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    sizes = np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts))
    starts = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum(sizes, out=starts[1:])
    return buf, starts


def word_spans(buf: np.ndarray, separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that are no separators."""
    is_sep = np.zeros(256, dtype=bool)
    is_sep[np.frombuffer(separators, dtype=np.uint8)] = True
    word = np.empty(len(buf) + 2, dtype=np.int8)
    word[0] = word[-1] = 0
    word[1:-1] = ~is_sep[buf]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Words:
    """Word hashes of several texts: ``hashes[first[i]:first[i + 1]]`` are text ``i``'s.

    ``start`` and ``end`` are byte positions within each text.
    """

    def __init__(self, parts: list[bytes], separators: bytes = SPACE, seed: int = 1):
        buf, starts = joined(parts)
        s, e = word_spans(buf, separators)
        self._ranges = RangeHash(buf, seed)
        self._s, self._e = s, e
        self.hashes = self._ranges.of(s, e)
        self.first = np.searchsorted(s, starts)
        base = np.repeat(starts[:-1], np.diff(self.first))
        self.start, self.end = s - base, e - base

    def prefixes(self, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes (or all) of each word."""
        return self._ranges.of(self._s, np.minimum(self._s + size, self._e))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``width`` consecutive words of one text, and each text's first one."""
        h, n = self.hashes, len(self.hashes)
        counts = np.maximum(np.diff(self.first) - width + 1, 0)
        first = np.zeros(len(counts) + 1, dtype=np.int64)
        np.cumsum(counts, out=first[1:])
        if first[-1] == 0:
            return np.empty(0, dtype=U64), first
        raw = np.zeros(n - width + 1, dtype=U64)
        for k in range(width):
            raw *= U64(BASE)
            raw += h[k:n - width + 1 + k]
        at = np.repeat(self.first[:-1] - first[:-1], counts) + np.arange(first[-1])
        return mix(raw[at]), first


def lowered(texts: pa.Array) -> list[bytes]:
    """Lower-cased UTF-8 bytes of each text; null gives none."""
    column = pc.fill_null(pc.utf8_lower(texts.cast(pa.large_string())), "")
    return column.cast(pa.large_binary()).to_pylist()


def slices(sizes: list[int], most: int):
    """Consecutive ranges whose sizes add up to at most ``most`` (or hold one item)."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
