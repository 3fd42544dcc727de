"""Integer arrays as small binaries, for shuffles of many numbers in few rows."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

_CODEC = "zstd"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed binary; bytes of equal weight stand together, so small numbers cost little."""
    parts = [struct.pack("<q", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(struct.pack("<8sq", a.dtype.str.encode(), len(a)))
        parts.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    raw = b"".join(parts)
    return struct.pack("<q", len(raw)) + pa.compress(raw, codec=_CODEC, asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], struct.unpack_from("<q", blob)[0], codec=_CODEC, asbytes=True)
    (n,), at, out = struct.unpack_from("<q", raw), 8, []
    for _ in range(n):
        kind, size = struct.unpack_from("<8sq", raw, at)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        at += 16
        end = at + size * dtype.itemsize
        out.append(np.frombuffer(raw[at:end], np.uint8).reshape(dtype.itemsize, size).T.copy().view(dtype).reshape(size))
        at = end
    return out


def first_of_runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """Whether a row of sorted columns differs from the one before."""
    out = np.ones(len(sorted_columns[0]), dtype=bool)
    out[1:] = False
    for c in sorted_columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def run_starts(*sorted_columns: np.ndarray) -> np.ndarray:
    return np.flatnonzero(first_of_runs(*sorted_columns))


def united(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals that overlap or touch, as one; ``start`` ascends."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    first = np.ones(len(start), dtype=bool)
    first[1:] = start[1:] > reach[:-1]
    at = np.flatnonzero(first)
    return start[at], np.maximum.reduceat(end, at)
