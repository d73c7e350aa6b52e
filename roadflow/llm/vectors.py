"""Helpers for embedding tables: valid rows, a bounded sample, spherical k-means, complete groups of blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 20_000


def usable(embedding: Column) -> Column:
    """Not null, not empty, not zero, every component finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """Rows of equal length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample_rows(rows: DataFrame, most: int = SAMPLE, original: bool = False) -> np.ndarray:
    """At most ``most`` unit (or ``original``) vectors (the smallest hashes of the vector), in a fixed order."""
    got = rows.orderBy(F.xxhash64("embedding")).limit(most).select("embedding").toArrow()
    if not got.num_rows:
        return np.zeros((0, 1))
    return matrix(got.column(0)) if original else unit(matrix(got.column(0)))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """k unit centroids (fewer if there are fewer rows): assign by cosine, then normalise the sums."""
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    if not len(x):
        return np.zeros((0, x.shape[1]))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        cell = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres
