"""Vectors of Arrow columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def lengths(column: pa.Array) -> np.ndarray:
    """Length of every vector; -1 where it is null."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a column that are all of length `dim`, as doubles; null components become NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.null_count:
        values[flat.is_null().to_numpy(zero_copy_only=False)] = np.nan
    return values.reshape(-1, dim)


def kmeans(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """At most k centres of the points, by Lloyd's rounds from a random choice."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        home = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, points)
        counts = np.bincount(home, minlength=len(centres))
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every centre."""
    out = (points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1)[None]
    return np.maximum(out, 0, out=out)


def nearest(points: np.ndarray, centres: np.ndarray, at_once: int = 4096) -> np.ndarray:
    found = [squares(points[i : i + at_once], centres).argmin(1) for i in range(0, len(points), at_once)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)
