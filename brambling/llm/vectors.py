"""Helpers for columns of vectors: which rows hold a usable one, and batches as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brambling.llm.common import col


def as_floats(df: DataFrame, name: str) -> Column:
    """The column as an array of float or, for every other number, of double."""
    kind = df.select(col(name)).schema[0].dataType
    return col(name) if kind == T.ArrayType(T.FloatType(), kind.containsNull) else col(name).cast("array<double>")


def finite(v: Column) -> Column:
    """False for null and empty vectors and for those with a null or non-finite component."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad, F.lit(False))


def nonzero(v: Column) -> Column:
    return F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def by_width(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of the lists in a batch, values as double."""
    bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = np.diff(bounds)
    for d in np.unique(width):
        rows = np.flatnonzero(width == d)
        yield rows, flat[bounds[rows][:, None] + np.arange(d)]


def blobs(matrix: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    data = np.ascontiguousarray(matrix)
    step = data.shape[1] * data.itemsize
    ends = np.arange(len(data) + 1, dtype=np.int64) * step
    return pa.Array.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def from_blobs(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of equal length back from their bytes."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(memoryview(data)[ends[0]:ends[-1]] if data is not None else b"", kind).reshape(len(column), width)


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one.  A power of two is taken out first, so that squares neither overflow nor vanish."""
    scaled = np.ldexp(matrix, -np.frexp(np.abs(matrix).max(1, keepdims=True))[1])
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
