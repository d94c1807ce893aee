"""Helpers of the operators on embedding tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components beyond it, once scaled, are held at it.
MOST = 1 << 62


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound, F.lit(False))


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; a shorter vector is continued by zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def whole_numbers(values: np.ndarray, scale: int, add: int = 0) -> np.ndarray:
    """floor(scale * value) + add as 64-bit integers, held within ``MOST``."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    return np.clip(scaled, -float(MOST), float(MOST)).astype(np.int64) + add
