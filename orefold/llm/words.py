"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A text column arrives as one byte buffer with row offsets. Word borders and 64-bit
word hashes are computed over the buffer at once, so no Python object is made per
word. UTF-8 lets this work on bytes: every byte of a character beyond ASCII is at
least 0x80, and both word classes below treat those alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are taken in slices of about this many bytes; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20
# Bytes hashed with one table of powers.
_BLOCK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes that belong to a word: all but white space ...
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# ... or letters a-z, digits and everything beyond ASCII (after lower-casing A-Z).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(_BASE, _BLOCK + 1)
_INVERSES = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), _BLOCK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``; spans ascend and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + _BLOCK, "right")))
        size = int(ends[j - 1]) - base
        powers, inverses = _POWERS, _INVERSES
        if size > _BLOCK:
            powers = _powers(_BASE, size + 1)
            inverses = _INVERSES  # one span, at offset 0
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((data[base : base + size].astype(np.uint64) + np.uint64(1)) * powers[:size], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * inverses[s] + (e - s).astype(np.uint64))
        i = j
    return out


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = words[:n].copy()
    for i in range(1, k):
        out *= _BASE
        out += words[i : i + n]
    return mix(out)


@dataclass
class Texts:
    """A slice of rows: ``data`` holds the texts, row r from ``offsets[r]`` to ``offsets[r + 1]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> Texts:
        return Texts(self.first, LOWER[self.data], self.offsets)

    def words(self, kind: np.ndarray) -> Words:
        """Maximal runs of bytes of ``kind`` within each row."""
        data, cuts = self.data, self.offsets
        inside = kind[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        borders = cuts[(cuts > 0) & (cuts < len(data))]
        opens[borders] = inside[borders]
        closes[borders - 1] = inside[borders - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        return Words(starts, ends, hash_spans(data, starts, ends), np.searchsorted(starts, cuts))


@dataclass
class Words:
    """Row r has the words from ``rows[r]`` to ``rows[r + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Texts]:
    """The rows of a string column in slices of bounded size; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, where, chars = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(chars, dtype=np.uint8) if chars is not None else np.empty(0, dtype=np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield Texts(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column with ``lengths[r]`` of the values in row r."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
