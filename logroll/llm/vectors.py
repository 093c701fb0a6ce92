"""Vector tables as numpy blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def usable(c: Column) -> Column:
    """Not null, no null and no non-finite component."""
    return c.isNotNull() & ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def matrix(column, width: int, kind) -> np.ndarray:
    """(rows, width) array of an Arrow list column; shorter vectors are padded with zeros."""
    if column.offset:
        column = column.take(np.arange(len(column)))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    at = np.asarray(column.offsets)
    n = np.diff(at)
    if len(n) and (n == width).all():
        return flat.reshape(-1, width).astype(kind, copy=False)
    out = np.zeros((len(n), width), kind)
    for i in range(len(n)):
        out[i, :n[i]] = flat[at[i]:at[i + 1]]
    return out


def width_of(vectors: DataFrame, column: str) -> int:
    return vectors.agg(F.max(F.size(column))).first()[0] or 0
