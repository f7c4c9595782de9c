"""Vector columns as numpy arrays, and which vectors take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))


def usual_length(vectors: DataFrame, vector_col: str) -> int:
    """The commonest length of the vectors, the larger of two as common; 0 for an empty table."""
    top = (vectors.groupBy(F.size(vector_col).alias("dims")).count()
           .orderBy(F.col("count").desc(), F.col("dims").desc()).limit(1).collect())
    return int(top[0]["dims"]) if top else 0


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``dims`` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)
