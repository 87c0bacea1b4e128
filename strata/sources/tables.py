"""Keyed Parquet tables: upsert and type-2 history by rewriting only the partitions a batch touches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.incremental import merge_upsert
from strata.operators.scd2 import scd2_apply
from strata.session import staged
from strata.sources.bronze import replace_partitions
from strata.sources.files import delete_folder, names
from strata.sources.versions import VERSIONS, version_folder

BUCKET = "key_bucket"
STATE = "closed_in"
OPEN = "open"
ARCHIVE = "archive"


def hash_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Even spread for any key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def range_bucket(key: str, width: int) -> Column:
    """Neighbouring ids together. Ids grow with creation time and recent entities change most, so a daily batch
    touches few buckets of a large table."""
    return F.floor(F.col(key) / width).cast("int")


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` (its newest version, if it is replaced as a whole), or None while there is nothing."""
    held = names(spark, path)
    if VERSIONS in held:
        path = version_folder(spark, path) or path
    elif all(n.startswith(("_", ".")) and "=" not in n for n in held):  # nothing yet, or only empty batches
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # only empty batches so far
            return None
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A keyed table without its layout columns."""
    df = read_or_none(spark, path)
    return None if df is None else df.drop(BUCKET, STATE)


def read_open(spark: SparkSession, path: str) -> DataFrame | None:
    """Open versions of a type-2 table: closed history is pruned by its partition, its files are not opened."""
    df = read_or_none(spark, path)
    return None if df is None else df.filter(F.col(STATE) == OPEN).drop(BUCKET, STATE)


def touched_buckets(batch: DataFrame) -> list[int]:
    """Bucket numbers of a batch, at most as many as the table has partitions."""
    return [r[0] for r in batch.select(BUCKET).distinct().collect()]


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    newer_by: Sequence[str] | None = None,
) -> int:
    """Merge ``updates`` (unique per key) into the table at ``path``; returns the rows in the rewritten partitions.

    The batch is written to the shared folder first, since it is used several times and may itself derive from
    this table. Rewriting goes through Spark's dynamic partition overwrite: partitions the batch does not touch
    are neither read nor written, and a lost executor only repeats tasks.
    """
    with staged(updates.dropna(subset=list(keys)).withColumn(BUCKET, bucket), "upsert") as batch:
        target = read_or_none(spark, path)
        if target is not None:
            target = target.filter(F.col(BUCKET).isin(touched_buckets(batch)))
        return replace_partitions(merge_upsert(target, batch, keys, newer_by), path, [BUCKET], gather=True)


def snapshot_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    run_id: str,
    apply: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> int:
    """Apply a batch to the type-2 table at ``path`` with ``apply(open versions, batch)``.

    Open versions and each run's closed versions lie in partitions of their own. Only the open partitions of the
    touched buckets are read and rewritten; closed history is written once and never again.
    """
    with staged(source.dropna(subset=list(keys)).withColumn(BUCKET, bucket), "snapshot") as batch:
        table = read_or_none(spark, path)
        if table is None:
            after = apply(None, batch)
        else:
            mine = table.filter(F.col(BUCKET).isin(touched_buckets(batch)))
            after = apply(mine.filter(F.col(STATE) == OPEN).drop(STATE), batch)
        state = F.when(F.col("valid_to").isNull(), F.lit(OPEN)).otherwise(F.lit(run_id))
        after = after.withColumn(STATE, state)
        if table is not None:
            # a repeated run id keeps the versions it closed before
            after = after.unionByName(mine.filter(F.col(STATE) == run_id))
        return replace_partitions(after, path, [STATE, BUCKET], gather=True)


def compact_history(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> int:
    """Put the closed versions of all runs but ``keep`` into one partition per bucket; returns their number.

    Each run adds folders for the versions it closed, and listing them grows with the runs. Run this while nothing
    reads the table. If it stops between writing and deleting, run it again: a version counts once, by its id.
    """
    table = read_or_none(spark, path)
    if table is None:
        return 0
    runs = [r[0] for r in table.select(STATE).distinct().collect()]  # folder names
    old = [r for r in runs if r not in (OPEN, ARCHIVE, *keep)]
    if not old:
        return 0
    closed = table.filter(F.col(STATE).isin([ARCHIVE, *old])).withColumn(STATE, F.lit(ARCHIVE))
    with staged(closed.dropDuplicates(["scd_id"]), "compact") as rows:
        n = replace_partitions(rows, path, [STATE, BUCKET], gather=True)
    for run in old:
        delete_folder(spark, f"{path}/{STATE}={run}")
    return n


def snapshot_by_timestamp(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    updated_at: str,
    bucket: Column,
    run_id: str,
    refresh: Sequence[str] = (),
) -> int:
    return snapshot_table(
        spark, path, source, keys, bucket, run_id,
        lambda target, batch: scd2_apply(target, batch, keys, "timestamp", updated_at=updated_at, refresh=refresh),
    )


def snapshot_by_check(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    as_of: Column,
    bucket: Column,
    run_id: str,
) -> int:
    return snapshot_table(
        spark, path, source, keys, bucket, run_id,
        lambda target, batch: scd2_apply(target, batch, keys, "check", check_cols=check_cols, as_of=as_of),
    )


def export_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Write each table to ``path/name``, replacing the previous export."""
    if not path:
        raise ValueError("an export path is required")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def read_export(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")
