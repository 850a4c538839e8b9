"""Vectors of Arrow batches as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) for each length in an array<double> column: the vectors without null or non-finite entries."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry is NaN
    starts = np.concatenate(([0], np.cumsum(np.maximum(lengths, 0))[:-1])) if len(lengths) else lengths
    for n in np.unique(lengths[lengths >= 0]):
        at = np.flatnonzero(lengths == n)
        matrix = values[starts[at][:, None] + np.arange(n)]
        ok = np.isfinite(matrix).all(axis=1)
        yield at[ok], matrix[ok]


def most_frequent(counts: list) -> int | None:
    """The length most rows have, of (n, count) rows; the larger of equals."""
    return max(counts, key=lambda r: (r["count"], r["n"]))["n"] if counts else None
