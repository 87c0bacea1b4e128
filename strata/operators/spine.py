"""Calendars, dense series and fixed category lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import date_key


def date_dim(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Calendar rows for the one-row frame of first and last day."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date_actual"))
    return days.select(
        date_key("date_actual").alias("date_key"),
        "date_actual",
        F.year("date_actual").alias("year"),
        F.quarter("date_actual").alias("quarter"),
        F.month("date_actual").alias("month"),
        F.weekofyear("date_actual").alias("week_of_year"),
        F.dayofweek("date_actual").alias("day_of_week"),
    )


def densify(df: DataFrame, start: Column, end: Column, name: str = "month_year") -> DataFrame:
    """Every row of ``df`` once per month from ``start`` to ``end``.

    The months are a generated array on each row, not a second table, so there is nothing to join or ship.
    """
    months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    return df.withColumn("__month", F.explode(months)).withColumn(name, F.date_format("__month", "yyyy-MM")).drop(
        "__month"
    )


def zero_fill(df: DataFrame, categories: Sequence[str], key: str, measure: str) -> DataFrame:
    """One row per category in the given order, 0 where ``df`` has none. Other keys are left out."""
    spark = df.sparkSession
    fixed = spark.createDataFrame([(i, c) for i, c in enumerate(categories)], f"position int, {key} string")
    # the counts are already one row per category, so this join moves no more than that
    return fixed.join(df.select(key, measure), key, "left").select(
        "position", key, F.coalesce(measure, F.lit(0)).alias(measure)
    )
