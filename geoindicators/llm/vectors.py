"""Integer vectors for the operators on embeddings: which rows take part, quantisation, matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Squared norms stay under this, so that inner products and squared distances fit a long.
MOST_SQUARED = float(1 << 60)


def finite(vector: Column) -> Column:
    """True where the array is not null and holds neither nulls nor NaN nor infinities."""
    inner = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & inner, F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as array<bigint>; an error where the squared norm doesn't fit a long."""
    norm = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(F.lit(float(scale)) * x.cast("double"), F.lit(2.0)))
    q = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return F.when(norm < MOST_SQUARED, q).otherwise(F.raise_error(F.lit("a vector's squared norm doesn't fit a long")))


def longest(rows: DataFrame, column: str) -> int:
    """Components of the longest vector; shorter ones count as padded with zeros."""
    return int(rows.agg(F.coalesce(F.max(F.size(column)), F.lit(0))).first()[0])


def matrix(lists: pa.Array | pa.ChunkedArray, width: int, kind=np.int64) -> np.ndarray:
    """(rows, width) of an Arrow list column, shorter rows padded with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False)
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if (size == width).all():
        return values.reshape(len(lists), width).astype(kind, copy=False)
    out = np.zeros((len(lists), width), dtype=kind)
    row = np.repeat(np.arange(len(lists)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def lists(values: np.ndarray) -> pa.Array:
    """An Arrow list column of a matrix's rows."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.ravel()))
