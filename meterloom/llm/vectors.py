"""What the vector operators share: valid vectors, matrices of Arrow lists, rotations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid(df: DataFrame, identity: str, vector: str) -> DataFrame:
    """``id`` and ``v`` of the vectors that are not null, empty or zero, with finite parts only."""
    v = F.col(vector).cast("array<float>")
    finite = F.forall(
        "v",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
    )
    return (
        df.select(F.col(identity).cast("bigint").alias("id"), v.alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
        .filter(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    )


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length."""
    n = len(column)
    if n == 0:
        return np.zeros((0, 0), np.float32)
    bounds = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[n]]
    return flat.reshape(n, -1)


def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    random = np.random.default_rng(seed)
    q, r = np.linalg.qr(random.standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))
