"""What the operators on embeddings share: which vectors count, and rotations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str) -> Column:
    """True for vectors with finite components only, of which one at least is not 0."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame, *keys: str) -> DataFrame:
    """One row per different vector (and ``keys``): ``rep`` (smallest vec_id), ``copies``.

    Copies merge before they are shuffled, so one vector may fill a third of the table.
    """
    return vectors.groupBy(*keys, "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))


def matrix(column: pa.ListArray, dtype=np.float64) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, against overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))
