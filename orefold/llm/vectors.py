"""Vector columns as integer matrices, straight from Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def whole_vectors(column: pa.Array, scale: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The usable rows of a list column, their components times ``scale`` rounded down, and their lengths.

    Null rows and rows with a null, NaN or infinite component are left out. The
    components stand one row after the other; an empty vector is a row without any.
    Beyond ``largest`` a whole number counts as that, so that sums of products fit 64 bits.
    """
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        raise TypeError(f"a list of numbers is needed, not {column.type}")
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    good = pc.is_valid(column).to_numpy(zero_copy_only=False).astype(bool)
    fine = np.isfinite(values)
    if not fine.all():
        good[np.unique(row[~fine])] = False
    if not good.all():
        values = values[good[row]]
    whole = np.clip(np.floor(values * scale), -largest, largest).astype(np.int64)
    rows = np.flatnonzero(good)
    return rows, whole, lengths[rows]


def matrix(whole: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """One row per vector, shorter ones followed by zeros."""
    n = len(lengths)
    if n and (lengths == width).all():
        return whole.reshape(n, width)
    out = np.zeros((n, width), dtype=whole.dtype)
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(n), lengths)
    out[row, np.arange(len(whole)) - starts[row]] = whole
    return out
