"""What the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for a vector with finite components that are not all zero."""
    return F.coalesce(F.expr(f"size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists({vector}, x -> x <> 0)"), F.lit(False))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of doubles; shorter rows are filled with zeros up to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = width or (int(sizes[0]) if len(sizes) else 0)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def as_doubles(df: DataFrame, vector: str) -> Column:
    return df[vector].cast("array<double>")
