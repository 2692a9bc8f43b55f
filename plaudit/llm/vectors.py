"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.common import uniform


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has finite components only, not all of them 0.

    Null vectors and those that hold a null, a NaN or an infinity take no part. Vectors are compared with those of
    their own length only.
    """
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists(vector, lambda x: x != 0)
    return df.filter(F.coalesce(finite, F.lit(False)))


def lengths(rows: DataFrame, vector: str = "embedding") -> list[int]:
    """The lengths of the vectors, one index each."""
    return sorted(row.n for row in rows.select(F.size(vector).alias("n")).distinct().collect())


def as_matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample(rows: DataFrame, key: str, vector: str, total: int, limit: int) -> np.ndarray:
    """Unit vectors of about ``limit`` rows, drawn by a hash of the key, in the order of keys; on the driver."""
    share = min(1.0, limit / max(total, 1))
    drawn = rows.filter(uniform(F.col(key), seed="vectors") < share).select(key, vector).collect()
    drawn.sort(key=lambda r: r[0])
    return unit_rows(as_matrix([r[1] for r in drawn])) if drawn else np.empty((0, 0))
