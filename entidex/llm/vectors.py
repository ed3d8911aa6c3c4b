"""What the vector operators share: components as integers, and exact distances between them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Integers beyond count as this, so that a squared distance of 64 components fits a long.
MOST = 1 << 27


def is_whole(vector: Column, components: int) -> Column:
    """Whether a vector has this many components, none null, NaN or infinite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # NaN is above all
    return F.coalesce((F.size(vector) == components) & finite, F.lit(False))


def integers(vectors: pa.Array, components: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component of whole vectors, one row each."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, components)
    return np.clip(np.floor(values * scale), -MOST, MOST).astype(np.int64)


def squared_distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to every row of `to`, as integers."""
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(to).max(initial=0)))
    # Doubles hold all sums below 2^53; their product is many times faster.
    kind = np.float64 if 4 * rows.shape[1] * most * most < 1 << 53 else np.int64
    a, b = rows.astype(kind), to.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def narrow(values: np.ndarray) -> tuple[bytes, str]:
    """Integers as bytes of the narrowest kind that holds them, and that kind."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    kind = np.promote_types(np.min_scalar_type(low), np.min_scalar_type(high))
    kind = kind if kind.kind in "iu" else np.dtype(np.int64)
    return np.ascontiguousarray(values, kind).tobytes(), kind.str


def wide(data: bytes, kind: str, columns: int) -> np.ndarray:
    """The integers of `narrow`, as rows of so many columns."""
    return np.frombuffer(data, np.dtype(kind)).astype(np.int64).reshape(-1, columns)
