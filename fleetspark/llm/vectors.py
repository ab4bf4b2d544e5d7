"""Vectors as rows: reading, packing for tasks, and folding equal ones."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_vectors(rows: DataFrame, allow_zero: bool) -> DataFrame:
    """vec_id, v (array<double>) of the vectors that take part, whatever other columns there are."""
    whole = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    kept = (
        rows.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
        )
        .where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
        .where(whole)
    )
    return kept if allow_zero else kept.where(F.exists("v", lambda x: x != 0))


def firsts_of_equal(rows: DataFrame, key: Column, k: int) -> DataFrame:
    """Of rows with one key, those of the k + 1 smallest ids, at most k of each id: no other can be
    among any k nearest, as all tie and one id may be the query's own. The limits are applied
    before the shuffles too."""
    from pyspark.sql import Window

    copy = F.row_number().over(Window.partitionBy(key, "vec_id").orderBy("vec_id"))
    place = F.dense_rank().over(Window.partitionBy(key).orderBy("vec_id"))
    few = rows.withColumn("__copy", copy).where(F.col("__copy") <= k).drop("__copy")
    return few.withColumn("__place", place).where(F.col("__place") <= k + 1).drop("__place")


def matrix(column) -> np.ndarray:
    """A table column of equally long arrays as rows of doubles."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
