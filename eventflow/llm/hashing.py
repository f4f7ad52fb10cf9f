"""Hashes of words, word shingles and byte windows, computed for whole batches at once.

A polynomial hash modulo 2^64 with an odd base has inverse powers, so the hash of any
range is a difference of two prefix sums times one inverse power. Results are mixed to
spread all bits. Equal ranges always hash equally; all uses keep 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
SECOND = 0xD1342543DE82EF95  # for hashes independent of the first ones
CHUNK = 1 << 19  # bytes hashed at once


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads each bit over all others."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def byte_codes(base: int = BASE) -> np.ndarray:
    """A 64-bit code for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))


def fold_ascii() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold


def spaces() -> np.ndarray:
    """Byte table of separators: space and 0x09 to 0x0D."""
    sep = np.zeros(256, bool)
    sep[[0x20, *range(0x09, 0x0E)]] = True
    return sep


def spaces_and_marks() -> np.ndarray:
    """Byte table of separators: control codes and all ASCII but letters and digits."""
    sep = np.zeros(256, bool)
    sep[:128] = True
    sep[48:58] = sep[65:91] = sep[97:123] = False
    return sep


class Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self, base: int = BASE) -> None:
        self.n, self.base = 0, base

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= self.n:
            self.n = max(n + 1, CHUNK + 1)
            inverse = pow(self.base, -1, 1 << 64)
            up, down = np.full(self.n, self.base, np.uint64), np.full(self.n, inverse, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up, self.down


class WordHasher:
    """Hashes of the words of texts; words are maximal runs of non-separator bytes."""

    def __init__(self, sep: np.ndarray, fold: np.ndarray) -> None:
        self.sep, self.codes, self.powers = sep, byte_codes()[fold], Powers()

    def _hash(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        up, down = self.powers.upto(n)
        word = ~self.sep[data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        inner = bounds[(bounds > 0) & (bounds < n)]
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes[data] * up[:n], out=sums[1:])
        h = (sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)
        return mix(h), np.searchsorted(start, bounds)

    def _long(self, data: np.ndarray) -> np.ndarray:
        """A text over the chunk size, cut between words."""
        parts, a = [], 0
        while a < len(data):
            b = a + CHUNK
            while b < len(data):
                gap = np.flatnonzero(self.sep[data[b : b + CHUNK]])
                if len(gap):
                    b += int(gap[0])
                    break
                b += CHUNK
            parts.append(self._hash(data[a:b], np.array([0, len(data[a:b])]))[0])
            a = b
        return np.concatenate(parts)

    def __call__(
        self, data: np.ndarray, offsets: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Yields (first row, word hashes, word offsets of its rows) chunk by chunk."""
        row, rows = 0, len(offsets) - 1
        while row < rows:
            to = int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1
            if to <= row:
                h = self._long(data[offsets[row] : offsets[row + 1]])
                yield row, h, np.array([0, len(h)])
                row += 1
                continue
            bounds = offsets[row : to + 1] - offsets[row]
            yield (row, *self._hash(data[offsets[row] : offsets[to]], bounds))
            row = to


def shingles(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and their offsets by row.

    A row of 1 to k-1 words has its whole sequence as its one shingle, a row without
    words none.
    """
    sizes = np.diff(offsets)
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    start = np.arange(out[-1]) - np.repeat(out[:-1] - offsets[:-1], counts)
    h = np.full(len(start), k, np.uint64)
    if len(words) >= k:
        whole = np.minimum(start, len(words) - k)
        for j in range(k):
            h = mix(h * np.uint64(BASE) + words[whole + j])
    for i in np.flatnonzero((sizes > 0) & (sizes < k)):
        one = np.array([sizes[i]], np.uint64)
        for j in range(offsets[i], offsets[i + 1]):
            one = mix(one * np.uint64(BASE) + words[j])
        h[out[i]] = one[0]
    return h, out
