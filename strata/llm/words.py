"""Words of a text column as arrays: spans, 64-bit hashes, shingles.

A word is a run of bytes other than space and 0x09-0x0D; in UTF-8 these
bytes never occur inside a character.  Hashes are polynomials modulo 2^64
(prefix sums of bytes times powers of an odd base, shifted back by the
base's inverse) with a final bit mix, so a text's words and shingles are
hashed without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from strata.llm.worker import POWERS

CHUNK_BYTES = 1 << 20
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
ONE = np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; tables up to a chunk's length (8 MB) are kept."""
    have = POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = ONE
        np.multiply.accumulate(have, out=have)
        if len(have) <= CHUNK_BYTES + 1:
            POWERS[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    """Words of consecutive texts.  ``first[i]:first[i+1]`` are the words of
    text ``low + i``; ``start`` and ``end`` are byte positions in ``data``."""

    low: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    base: np.ndarray        # byte position at which each text starts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        if not len(self.start):
            return np.empty(0, np.uint64)
        b = (LOWER[self.data] if lower else self.data).astype(np.uint64)
        b += ONE
        b *= powers(BYTE_BASE, len(b))
        sums = np.empty(len(b) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(b, out=sums[1:])
        h = sums[self.end] - sums[self.start]
        h *= powers(inverse(BYTE_BASE), len(b))[self.start]
        return mix(h)

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rolling (Rabin-Karp) hash of every k consecutive words inside one
        text, and the first word's index of each."""
        n = len(hashes)
        if n < k:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)      # words left in the text
        at = np.flatnonzero(left >= k)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(hashes * powers(WORD_BASE, n), out=sums[1:])
        h = sums[at + k] - sums[at]
        h *= powers(inverse(WORD_BASE), n)[at]
        return mix(h), at

    def shingles(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes and the index of each one's text: all windows of k
        words; a text with fewer words has its whole sequence as one."""
        h, at = self.windows(hashes, k)
        owner = self.owner()
        short = np.flatnonzero((self.counts > 0) & (self.counts < k))
        if len(short):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(WORD_BASE, len(hashes)), dtype=np.uint64)])
            lo, hi = self.first[short], self.first[short + 1]
            whole = (sums[hi] - sums[lo]) * powers(inverse(WORD_BASE), len(hashes) + 1)[lo]
            whole = mix(whole + (hi - lo).astype(np.uint64) * BYTE_BASE)
            h, at = np.concatenate([h, whole]), np.concatenate([at, lo])
            order = np.argsort(at, kind="stable")
            h, at = h[order], at[order]
        return h, owner[at]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text offsets of a string column; nulls are empty."""
    col = column.fill_null("") if column.null_count else column
    col = col.cast(pa.large_binary())
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    return np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8), offsets


def word_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """The column's texts in order, as chunks of whole texts of about
    ``chunk_bytes`` (a longer text is a chunk of its own)."""
    data, offsets = buffers(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + chunk_bytes, "right")) - 1
        high = min(max(high, low + 1), n)
        yield _words(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], low)
        low = high


def _words(data: np.ndarray, base: np.ndarray, low: int) -> Words:
    inside = ~SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = base[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]      # a text's end cuts a word
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(low, data, start, end, np.searchsorted(start, base), base)
