"""Vectors of a table as rows of float64 bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Lengths of vectors that a table may hold; each is searched by itself.
LENGTHS = 64


def valid(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part: not null, not zero, all components finite."""
    v = F.col("v")
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return out.where("vec_id is not null and v is not null and size(v) > 0").where(finite & F.exists(v, lambda x: x != 0))


def lengths(vectors: DataFrame) -> list[int]:
    """The lengths of a table's vectors, as only vectors of one length can be compared; an error if there are more than LENGTHS."""
    found = sorted(r.d for r in vectors.select(F.size("v").alias("d")).distinct().limit(LENGTHS + 1).collect())
    if len(found) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    return found


def matrix(column) -> np.ndarray:
    """An Arrow or pandas column of equally long lists of doubles as a matrix."""
    if hasattr(column, "flatten") and hasattr(column, "type"):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)
