"""Words of many texts at once, and 64-bit names of words and word windows (numpy, inside tasks).

A word's names are the halves of its 128-bit hash, taken once per distinct word
of a batch. A window's name is a polynomial over 64-bit integers of its words'
names and comes from two prefix sums. (Words themselves are not named by such
polynomials: some long strings have equal ones for every base.) Names depend on
the content alone and are the same in every task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses
FOLD_AZ = np.arange(256, dtype=np.uint8)
FOLD_AZ[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=4)
def _bytes_names(which: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(BASES[which]) + U(which))


@lru_cache(maxsize=8)
def _powers(n: int, which: int, inverse: bool) -> np.ndarray:
    base = pow(BASES[which], -1, 1 << 64) if inverse else BASES[which]
    return np.cumprod(np.concatenate([np.ones(1, U), np.full(n, base, U)]), dtype=U)


def powers(n: int, which: int, inverse: bool = False) -> np.ndarray:
    """At least n + 1 powers of a base (computed for the next power of two)."""
    return _powers(1 << max(16, int(n).bit_length()), which, inverse)


def spans_names(items: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Names of items[start:end] for many spans."""
    n = len(items)
    sums = np.zeros(n + 1, U)
    np.cumsum(items * powers(n, which)[:n], out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(n, which, True)[start] + (end - start).astype(U))


class Words:
    """The words of a text column.

    doc: row of each word; first: index of each row's first word (and a last
    entry); start, end: bytes of each word in ``data``; begins: bytes of each row.
    """

    def __init__(self, texts: pa.Array, fold: bool = False):
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        self.data = FOLD_AZ[data] if fold else data
        self.begins = offsets - offsets[0]
        inside = ~SPACE[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        edges = self.begins[(self.begins > 0) & (self.begins < len(data))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, self.begins)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.hashes = None  # of the words, made when asked for

    def names(self, which: int = 0) -> np.ndarray:
        """First or second half of every word's hash."""
        if self.hashes is None:
            size = self.end - self.start
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(self.data[~SPACE[self.data]])])
            coded = words.dictionary_encode()
            digests = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
            self.hashes = np.frombuffer(digests, U).reshape(-1, 2)[coded.indices.to_numpy(zero_copy_only=False)]
        return self.hashes[:, which].copy()

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows of ``size`` words that stay in one row."""
        n = len(self.doc)
        if n < size:
            return np.zeros(0, np.int64)
        at = np.arange(n - size + 1)
        return at[self.doc[at] == self.doc[at + size - 1]]
