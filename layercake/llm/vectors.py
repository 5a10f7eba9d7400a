"""What the vector operators share: which vectors take part, and classes of
equal vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str = "embedding") -> Column:
    """False for vectors that are null, empty or zero, or hold a null, NaN or infinity."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def classes(vectors: DataFrame, keep: int = 0) -> DataFrame:
    """Equal vectors brought together: embedding, rep (smallest vec_id), size,
    and with ``keep`` the smallest that many vec_ids as members.

    Sums and minima are combined before the shuffle, and so are the smallest
    vec_ids (a window group limit), so one vector may hold a third of all rows."""
    sums = vectors.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    if not keep:
        return sums
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    return (vectors.select("embedding", "vec_id").withColumn("place", place).where(F.col("place") <= keep)
            .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
            .withColumn("rep", F.get("members", F.lit(0))))
