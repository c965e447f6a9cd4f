"""Vectors shared by the operators on embeddings: Arrow lists as numpy matrices,
integer entries, and which rows take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer entries beyond this count as this, so that 64 squared differences fit a long.
ENTRY_LIMIT = 1 << 27


def usable(vector: Column, dims: int | None = None) -> Column:
    """True for vectors (of ``dims`` entries, if given) without null, NaN or infinite entries."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    whole = vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))
    return whole if dims is None else whole & (F.size(vector) == dims)


def grid(vector: Column, limit: int = ENTRY_LIMIT) -> Column:
    """Entries as longs floor(256 * entry), cut at ``limit`` either way."""
    edge = float(limit)
    return F.transform(vector, lambda c: F.floor(
        F.greatest(F.least(c.cast("double") * 256, F.lit(edge)), F.lit(-edge))).cast("long"))


def common_length(vectors: DataFrame, col: str) -> int:
    """The most frequent length of the vectors (the greater on a tie); 0 for an empty table."""
    row = (vectors.groupBy(F.size(col).alias("dims")).count()
                  .orderBy(F.desc("count"), F.desc("dims")).first())
    return row.dims if row else 0


def matrix(column: pa.Array, dims: int, dtype: type) -> np.ndarray:
    """A list column without nulls, all lists of length ``dims``, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), dims)


def lists(values: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    ends = np.arange(0, values.size + 1, max(1, values.shape[1]), dtype=np.int32)
    if not values.shape[1]:
        ends = np.zeros(len(values) + 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def exact_gram(rows: np.ndarray) -> np.ndarray:
    """rows' * rows of an int64 matrix (entries up to 2 ** 41) as Python integers.

    Entries are split at 2 ** 20; products of the halves over 2 ** 11 rows are exact
    in double precision, so BLAS does the work and no sum is rounded."""
    dims = rows.shape[1]
    total = np.zeros((dims, dims), dtype=object)
    whole = lambda m: m.astype(np.int64).astype(object)
    for at in range(0, len(rows), 1 << 11):
        block = rows[at:at + (1 << 11)]
        high = np.sign(block) * (np.abs(block) >> 20)
        low = (block - (high << 20)).astype(np.float64)
        total += whole(low.T @ low)
        if high.any():
            high = high.astype(np.float64)
            mixed = whole(high.T @ low)
            total += (whole(high.T @ high) << 40) + ((mixed + mixed.T) << 20)
    return total
