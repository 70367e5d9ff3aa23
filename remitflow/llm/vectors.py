"""Vectors that can be compared, and rotations."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """Not null, not zero, and without null or non-finite components."""
    v = F.col(column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def by_dims(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix in double precision) for each number of dimensions among the vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        out.append((rows, flat.astype(np.float64).reshape(len(rows), d)))
    return out
