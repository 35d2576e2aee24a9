"""Vector columns: which rows hold numbers only, and their Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is there and holds numbers only."""
    infinite = F.lit(float("inf"))

    def number(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)

    return F.coalesce(F.forall(F.col(vector), number), F.lit(False))


def matrix(column: pa.Array, wide: int) -> np.ndarray:
    """The vectors of an Arrow list column as doubles, shorter ones padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == wide).all():
        return values.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide))
    out[np.arange(wide) < lengths[:, None]] = values
    return out
