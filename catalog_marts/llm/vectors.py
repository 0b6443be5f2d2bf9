"""Helpers for columns of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def packed(vector: Column) -> Column:
    return vector.cast("array<double>")


def rows_of(column: pa.Array) -> np.ndarray:
    """The vectors of a list column, which must have one length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lists_of(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(matrix).ravel()))
