"""Vector columns as integer matrices: x = floor(256 * c) of every entry c, as 64-bit numbers.

A vector that is null, or holds a null or non-finite entry, has no x. One that is shorter than the
longest of its table is filled up with zeros. Packed, a vector takes 1, 2, 4 or 8 bytes an entry,
the fewest that hold all its entries, so equal vectors have equal bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SCALE = 256
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def dimension(df: DataFrame, vector: str) -> int:
    """The length of the longest vector, 0 if there is none."""
    return df.agg(F.max(F.size(f"`{vector}`"))).first()[0] or 0


def whole(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``column`` that have an x, and their x as a matrix of ``size`` columns."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    finite = np.isfinite(values)
    row = np.repeat(np.arange(len(column)), lengths)
    good = ~np.asarray(pc.is_null(column)) & (np.bincount(row[~finite], minlength=len(column)) == 0)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    keep = good[row]
    scaled = np.floor(SCALE * values[keep])
    if len(scaled) and np.abs(scaled).max() >= 2.0 ** 62:
        raise ValueError("a vector has entries that do not fit 64-bit numbers")
    x = np.zeros((int(good.sum()), size), np.int64)
    x[(np.cumsum(good) - 1)[row[keep]], place[keep]] = scaled.astype(np.int64)
    return np.flatnonzero(good), x


def pack(x: np.ndarray) -> list[bytes]:
    """The bytes of each row."""
    out = [b""] * len(x)
    if not x.size:
        return out
    low, high = x.min(1), x.max(1)
    open_ = np.ones(len(x), bool)
    for kind in _WIDTHS:
        fits = open_ & (low >= np.iinfo(kind).min) & (high <= np.iinfo(kind).max)
        rows = np.flatnonzero(fits)
        data, step = x[rows].astype(kind).tobytes(), x.shape[1] * np.dtype(kind).itemsize
        for k, i in enumerate(rows.tolist()):
            out[i] = data[k * step:(k + 1) * step]
        open_ &= ~fits
    return out


def unpack(column: pa.Array, size: int) -> np.ndarray:
    """The matrix of packed rows."""
    x = np.zeros((len(column), size), np.int64)
    if not size:
        return x
    lengths = pc.binary_length(column).to_numpy()
    for kind in _WIDTHS:
        rows = np.flatnonzero(lengths == size * np.dtype(kind).itemsize)
        if len(rows):
            data = b"".join(column.take(pa.array(rows)).to_pylist())
            x[rows] = np.frombuffer(data, kind).reshape(len(rows), size)
    return x
