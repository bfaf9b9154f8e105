"""Vectors of a table as packed numbers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def usable(column: str) -> Column:
    """Not null, and every component a finite number."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(F.col(column).isNotNull() & finite, F.lit(False))


def longest(vectors: DataFrame, column: str) -> int:
    """The largest number of components; shorter vectors are read as if padded with zeros."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def matrix(arrays, size: int) -> np.ndarray:
    """Rows of equal length, padded with zeros."""
    out = np.zeros((len(arrays), size))
    for i, a in enumerate(arrays):
        out[i, : len(a)] = a
    return out
