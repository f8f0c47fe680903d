"""Packed vectors: rows of an array column as matrices, rows that take no part left out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors in double precision and the rows they come from, one matrix for each width.

    Rows that are null, empty, or hold a null or non-finite component take no part.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    offsets = np.asarray(column.offsets)
    sizes = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0) if n else np.zeros(0, np.int64)
    values = column.values.cast(pa.float64())
    flat = np.asarray(values.fill_null(np.nan)) if len(values) else np.zeros(0)
    for width in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == width)
        out = flat[offsets[:-1][rows][:, None] + np.arange(width)]
        good = np.isfinite(out).all(1)
        yield out[good], rows[good]
