"""Vector columns: one row per id, and which vectors can be compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_id(df: DataFrame, id: str, *values: str) -> DataFrame:
    """Rows that share an id are one vector: the first by the given columns, NULLs last."""
    order = F.struct(*[x for v in values for x in (F.col(v).isNull().alias(f"none_{v}"), F.col(v))])
    return df.groupBy(id).agg(F.min(order).alias("first")).select(id, *[f"first.{v}" for v in values])


def usable(vector: Column) -> Column:
    """Not NULL, not zero, without NULL, NaN or infinite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)
