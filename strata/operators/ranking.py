"""Ordered reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import written


def top_k(df: DataFrame, by: str | Column, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The k largest rows by ``by`` (nulls last). Spark keeps k rows per task, then merges those."""
    by = F.col(by) if isinstance(by, str) else by
    return df.orderBy(by.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(k)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows of an ordered frame with their position from 1 on, in the order in which the frame gives them.

    Rows are numbered within their task; only the tasks' counts are added up in one place.
    """
    held = written(df.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__id", 33).alias("__part")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = held.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumn("__part", part).join(starts, "__part").select(*df.columns, (F.col("__before") + within + 1).alias(name))
