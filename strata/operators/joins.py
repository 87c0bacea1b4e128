"""Reference lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_reference(
    df: DataFrame, dim: DataFrame, left: str | Column, right: str | Column, take: Sequence[str]
) -> DataFrame:
    """Left lookup of ``take`` columns by equality of two expressions; unmatched rows keep nulls.

    The dimension is cut to the key and the taken columns before the join, so its size estimate is the honest
    one when Catalyst decides whether it may be broadcast.
    """
    left = F.col(left) if isinstance(left, str) else left
    right = F.col(right) if isinstance(right, str) else right
    narrow = dim.select(right.alias("__ref"), *take)
    return df.withColumn("__key", left).join(narrow, F.col("__key") == F.col("__ref"), "left").drop("__key", "__ref")
