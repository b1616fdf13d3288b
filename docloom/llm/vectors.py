"""Vectors of Arrow batches as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column in double precision, padded with zeros to the longest, and which are usable: not null, not empty, all components finite."""
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(valid, np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(np.int64)
    flat = column.flatten()
    flat = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out, (lengths > 0) & np.isfinite(out).all(axis=1)


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))
