"""Integrity checks. Each returns the violating rows; an empty frame means the check passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (null keys are not compared)."""
    keyed = df.dropna(subset=list(keys))
    return keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_relationship(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key).alias("__parent"))
    present = child.filter(F.col(child_key).isNotNull())
    return present.join(parents, F.col(child_key) == F.col("__parent"), "left_anti")


def check_one_current(versions: DataFrame, keys: Sequence[str], valid_to: str = "valid_to") -> DataFrame:
    """Keys with more than one open version."""
    return check_unique(versions.filter(F.col(valid_to).isNull()), keys)
