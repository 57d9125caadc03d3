"""Whole Arrow batches of texts as flat numpy arrays: words, word hashes, shingles.

Everything works on the UTF-8 bytes in place, without a Python object per word.  A
batch is walked in runs of about a megabyte, so memory follows the run (or the
longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
SPACES = [0x20, *range(0x09, 0x0E)]
#: 1 for the bytes of words [^\x20\x09-\x0D]; bytes of multi-byte characters count.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[SPACES] = False
#: Letters and digits, with everything outside ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower-cases A-Z, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes; a longer text is a run by itself."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """The words of one run of texts: byte ``start`` and ``end`` in ``data``, 64-bit
    ``hash`` (of the A-Z-lower-cased bytes; of the bytes as they are without ``fold``),
    and ``bounds``: words of text i are ``bounds[i]:bounds[i + 1]``."""

    def __init__(
        self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NOT_SPACE, hashed: bool = True, fold: bool = True
    ):
        base = int(offsets[0])
        self.data = data[base : int(offsets[-1])]
        if fold:
            self.data = LOWER[self.data]
        self.offsets = offsets - base
        inside = word_bytes[self.data]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        before[cuts] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        after[cuts - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.start, self.offsets)
        if hashed:
            self.hash = self._hash(inside)

    def _hash(self, inside: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        first = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(first, length)
        powers = np.cumprod(np.full(int(length.max()), _ODD, np.uint64))
        value = _BYTES[self.data[inside]] * powers[place]
        return mix64(np.add.reduceat(value, first) + length.astype(np.uint64))

    def __len__(self) -> int:
        return len(self.bounds) - 1


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of sequences from the hashes of their elements, in order."""
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for p in parts:
        out = out * _ODD + p
        out = out ^ (out >> np.uint64(29))
    return mix64(out)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word shingles of one text; of the whole text when it has
    fewer words; none when it has none."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    return combine([hashes[i : n - k + 1 + i] for i in range(k)])
