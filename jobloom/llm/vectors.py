"""Vectors of an array column as matrices of whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def sound(vector: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def bound(dims: int, of_difference: bool = False) -> int:
    """The largest power of two to which components may go if sums of `dims` products of two of them
    (or of squares of their differences) are to fit 62 bits."""
    return 1 << max((62 - max(dims, 1).bit_length()) // 2 - of_difference, 0)


def whole(vectors: pa.ChunkedArray | pa.Array, scale: int, dims: int, most: int) -> np.ndarray:
    """floor(scale * x) of each component, row by row; shorter rows are filled with 0, components
    beyond `most` count as `most`."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(flat.offsets.to_numpy())
    with np.errstate(over="ignore"):
        values = np.floor(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    out = np.zeros((len(flat), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = np.clip(values, -most, most).astype(np.int64)
    return out


def exact_floats(*largest: int, dims: int) -> bool:
    """Whether sums of `dims` products of such numbers are exact in doubles."""
    product = dims
    for x in largest:
        product *= max(int(x), 1)
    return product < 1 << 53
