"""Vectors as whole numbers: which rows take part, and their components as a matrix."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Rows that a numpy kernel takes at a time.
ROWS = 8192


def finite(vector: str) -> Column:
    """Whether a vector is there and every component of it is a finite number."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(F.col(vector), bad), F.lit(False))


def width(rows: DataFrame, vector: str) -> int:
    """Components of the longest vector; 0 for no rows."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def limit(n: int) -> int:
    """The largest component of which n products sum to less than 2**62."""
    return math.isqrt((1 << 62) // max(n, 1)) // 2


def matrix(col: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    """Rows of n whole numbers; a shorter vector ends in zeros, a component beyond limit(n) counts as that."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = np.asarray(col.value_lengths(), np.int64)
    flat = np.clip(np.floor(SCALE * np.asarray(col.flatten(), np.float64)), -limit(n), limit(n)).astype(np.int64)
    if (size == n).all():
        return flat.reshape(len(size), n)
    out = np.zeros((len(size), n), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def parts(batch: pa.RecordBatch):
    """A batch in slices of at most ROWS rows."""
    for k in range(0, batch.num_rows, ROWS):
        yield batch.slice(k, ROWS)
