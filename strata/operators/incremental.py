"""High-watermark increments and keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_latest

EPOCH_SENTINEL = "1900-01-01 00:00:00"


def _floor_like(df: DataFrame, ts: str) -> Column:
    return F.lit(EPOCH_SENTINEL).cast(df.schema[ts].dataType)


def high_watermark(target: DataFrame, ts: str) -> Column:
    """Largest ``ts`` of the target as a scalar subquery; the sentinel when the target is empty."""
    return target.agg(F.coalesce(F.max(ts), _floor_like(target, ts)).alias("hwm")).scalar()


def hwm_filter(df: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """Rows newer than anything the target has seen; everything when there is no target yet.

    The bound is one scalar subquery, which Spark resolves first and hands to the Parquet reader, so row groups
    below the watermark are skipped.
    """
    return df if target is None else df.filter(F.col(ts) > high_watermark(target, ts))


def lookback_filter(
    df: DataFrame, target: DataFrame | None, ts: str, days: int = 3, scope: str | None = None
) -> DataFrame:
    """Rows not older than ``days`` before the target's newest row, overall or per ``scope`` value.

    With a scope, a value the target has never seen keeps all its rows (a backfill is not lost).
    """
    if target is None:
        return df
    back = F.make_dt_interval(F.lit(days))
    if scope is None:
        return df.filter(F.col(ts) >= target.agg(F.coalesce(F.max(ts) - back, _floor_like(target, ts))).scalar())
    bounds = target.groupBy(F.col(scope).alias("__scope")).agg((F.max(ts) - back).alias("__bound"))
    joined = df.join(bounds, F.col(scope) == F.col("__scope"), "left")
    return joined.filter(F.col("__bound").isNull() | (F.col(ts) >= F.col("__bound"))).select(*df.columns)


def dedup_since(
    df: DataFrame, target: DataFrame | None, keys: Sequence[str], order: Sequence[str], ts: str
) -> DataFrame:
    """Newest row per key over the whole history, where that row arrived after the watermark.

    Same rows as deduplicating everything and filtering afterwards (equal rows: the later arrival wins), but only
    the fresh rows go through the window. Of the older history just keys and order columns are read, and one best
    value per key and task is shuffled, so neither a long history nor a hot key reaches a single task whole.
    """
    order = [*order, *([] if ts in order else [ts])]
    best = dedup_latest(hwm_filter(df, target, ts), keys, order)
    if target is None:
        return best
    rank = F.struct(*[F.col(c) for c in order])
    older = df.filter(F.col(ts) <= high_watermark(target, ts)).dropna(subset=list(keys))
    older = older.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(rank).alias("__older"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"__{k}") for k in keys])
    joined = best.join(older, same, "left")
    return joined.filter(F.col("__older").isNull() | (rank > F.col("__older"))).select(*df.columns)


def merge_upsert(
    target: DataFrame | None, updates: DataFrame, keys: Sequence[str], newer_by: Sequence[str] | None = None
) -> DataFrame:
    """Target with ``updates`` applied by key: matched rows replaced, new rows added, nothing deleted.

    With ``newer_by`` a matched row is replaced only when the update is at least as new. Updates must be unique
    per key, and null keys belong in quarantine: they would match nothing and pile up on every rerun.
    """
    updates = updates.dropna(subset=list(keys))
    if target is None:
        return updates
    if newer_by is None:
        return target.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates)
    both = target.withColumn("__fresh", F.lit(0)).unionByName(updates.withColumn("__fresh", F.lit(1)))
    return dedup_latest(both, keys, [*newer_by, "__fresh"], tie_break=(), null_keys="drop").drop("__fresh")


def advance_watermarks(
    watermarks: DataFrame | None, boundaries: DataFrame, key: str = "repo", boundary: str = "boundary"
) -> DataFrame:
    """Watermark table after a finished run: one boundary per key, taken before extraction began."""
    return merge_upsert(watermarks, boundaries.select(key, boundary), [key])


def since_filter(
    df: DataFrame,
    watermarks: DataFrame,
    key: str,
    ts: str,
    boundary: str = "boundary",
    overlap_minutes: int = 10,
) -> DataFrame:
    """Rows at or after their key's watermark minus the overlap; keys without a watermark pass whole."""
    marks = watermarks.select(
        F.col(key).alias("__key"),
        (F.col(boundary) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(overlap_minutes))).alias("__since"),
    )
    joined = df.join(marks, F.col(key) == F.col("__key"), "left")
    return joined.filter(F.col("__since").isNull() | (F.col(ts) >= F.col("__since"))).select(*df.columns)
