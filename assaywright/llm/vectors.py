"""Whole-number vectors: from float arrays to exact integer components, and exact products of blocks of them.

A component ``x`` becomes ``floor(256 * x)``, with ``x`` as double.  Components
beyond 2**27 - 1 in size are held at that value, so that squared distances and
inner products of up to 128 of them stay within 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256.0
MOST = float((1 << 27) - 1)


def all_finite(vector: Column) -> Column:
    """The array is there and no component is NULL, NaN or infinite; an empty one qualifies."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole(vector: Column) -> Column:
    def component(x: Column) -> Column:
        return F.floor(F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.lit(SCALE) * x.cast("double")))).cast("int")

    return F.transform(vector, component)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column as one array of doubles; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two arrays of whole numbers, exact, as int64.

    Doubles are exact as long as no partial sum can reach 2**53; beyond that whole numbers are multiplied.
    """
    if not len(a) or not len(b) or not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if a.shape[1] * np.abs(a).max() * np.abs(b).max() < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def squares(a: np.ndarray) -> np.ndarray:
    """Squared length of each row, exact."""
    whole_numbers = a.astype(np.int64)
    return np.einsum("ij,ij->i", whole_numbers, whole_numbers)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows, exact."""
    return squares(a)[:, None] + squares(b)[None, :] - 2 * products(a, b)
