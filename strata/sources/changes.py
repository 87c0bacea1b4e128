"""Keyed tables that leave a change feed: what a write changes is written first, then the table follows from it.

Each write has a number. Its changed rows go to ``<table>/_changes/<number>``, then a plan file says that they are complete,
then the touched buckets of the table are rewritten from themselves and the changes, and a commit file ends the write. A run
that stops before the plan file has changed nothing; one that stops after it is finished by the next write, which applies the
same changes again (applying them twice gives the same table). So every change is in the feed exactly once, and a reader that
remembers the last number it has taken reads only files with changed rows.

The commit file also holds the writer's marks: how far it has read its own sources. They are kept with the data they belong
to, and the next run asks one small file instead of the table for a maximum.

A table belongs to this module or to the writers of ``tables``, not to both: those leave no changes. One job writes a table at a
time.
"""

from __future__ import annotations

import contextlib
import functools
import json
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_latest
from strata.operators.scd2 import scd2_changes, scd2_from_history
from strata.session import scratch_dir
from strata.sources.bronze import replace_partitions
from strata.sources.files import delete_folder, folder_bytes, names, read_text, write_text
from strata.sources.tables import BUCKET, OPEN, STATE, read_or_none, touched_buckets

CHANGE = "change"  # before, after; opened, closed, refreshed, passed (opened and closed by one write)
NUMBER = "change_no"
PLANNED, COMMITTED = ".planned", ".committed"
COMPRESSION = "zstd"  # keys of 32 hex digits take half the room
FEW_BUCKETS, LARGE_BYTES = 8, 32 << 20  # touched buckets, and changed bytes in each, from which a write is not gathered
Apply = Callable[[DataFrame, list[int], int], None]  # changed rows, their buckets, number of the write


class ChangeLog:
    """The change feed of the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, f"{path}/_changes"

    def _numbers(self, ending: str) -> list[int]:
        return [int(n.removesuffix(ending)) for n in names(self.spark, self.root) if n.endswith(ending)]

    def _at(self, number: int, ending: str = "") -> str:
        return f"{self.root}/{number:010d}{ending}"

    def newest(self) -> int:
        """Number of the last finished write; 0 before the first."""
        return max(self._numbers(COMMITTED), default=0)

    def marks(self) -> dict:
        """What the last finished write had read of its sources."""
        newest = self.newest()
        return json.loads(read_text(self.spark, self._at(newest, COMMITTED))) if newest else {}

    def writes(self, number: int = 0) -> list[int]:
        """Finished writes after ``number`` whose changes are kept."""
        kept = set(names(self.spark, self.root))
        return [n for n in sorted(self._numbers(COMMITTED)) if n > number and f"{n:010d}" in kept]

    def since(self, number: int = 0) -> DataFrame | None:
        """Changed rows of the finished writes after ``number``; None where there are none."""
        paths = [self._at(n) for n in self.writes(number)]
        return self.spark.read.parquet(*paths) if paths else None

    def forget(self, upto: int) -> None:
        """Delete the changes of writes up to ``upto``, which every reader has taken. The last write's marks stay."""
        for n in self._numbers(COMMITTED):
            if n <= upto:
                delete_folder(self.spark, self._at(n))
                if n < self.newest():
                    delete_folder(self.spark, self._at(n, PLANNED))
                    delete_folder(self.spark, self._at(n, COMMITTED))

    def finish(self, apply: Apply) -> None:
        """End a write that stopped half-way: apply its changes if they are complete, else drop them."""
        done, planned = set(self._numbers(COMMITTED)), set(self._numbers(PLANNED))
        for name in names(self.spark, self.root):
            if name.isdigit() and int(name) not in done | planned:
                delete_folder(self.spark, self._at(int(name)))
        for n in sorted(planned - done):
            changes = self.spark.read.parquet(self._at(n))
            apply(changes, touched_buckets(changes), n)
            self._commit(n)

    def write(self, changes: DataFrame | None, apply: Apply, marks: dict) -> int:
        """Write changes, let ``apply`` bring them into the table, and commit; returns the write's number.

        Without changes (None) only the marks are written.
        """
        number = self.newest() + 1
        if changes is not None:
            changes = changes.withColumn(NUMBER, F.lit(number))
            held, buckets = _written(changes, self._at(number))
        write_text(self.spark, self._at(number, PLANNED), json.dumps({**self.marks(), **marks}))
        if changes is not None and buckets:
            apply(held, buckets, number)
        self._commit(number)
        return number

    def _commit(self, number: int) -> None:
        write_text(self.spark, self._at(number, COMMITTED), read_text(self.spark, self._at(number, PLANNED)))


def _written(df: DataFrame, path: str) -> tuple[DataFrame, list[int]]:
    """``df`` as a table, and its buckets: at most as many as the table has partitions."""
    seen = Observation()
    rows = df.observe(seen, F.collect_set(BUCKET).alias("buckets"))
    rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), sorted(seen.get["buckets"])


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _without(rows: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key (null-safe) is not among ``gone``."""
    other = gone.select(*[F.col(k).alias(f"__{k}") for k in keys])
    return rows.join(other, _same(keys, "__"), "left_anti")


def merge_logged(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    merged: Callable[[Column, Column], Column] | None = None,
    marks: dict | None = None,
    keep: Callable[[Column, Column], Column] | None = None,
    stored: bool = False,
) -> int:
    """Merge ``batch`` (unique per key, keys may be null) into the table at ``path`` and log what changes.

    ``merged(old row or null, new row)`` is the row afterwards, null to delete it (without it: the new row); ``keep(old, new)``
    says which batch rows count at all. The feed holds the row ``before`` and the row ``after`` each change. Only touched buckets
    are read and rewritten. A ``stored`` batch is taken row by row from files that stay, such as another table's feed: it is read
    again where it is needed, others are written first.
    """
    log = ChangeLog(spark, path)

    def apply(changes: DataFrame, buckets: list[int], number: int) -> None:
        after = changes.filter(F.col(CHANGE) == "after").drop(CHANGE, NUMBER)
        table = read_or_none(spark, path)
        if table is not None:
            mine = table.filter(F.col(BUCKET).isin(buckets))
            after = _without(mine, changes, keys).unionByName(after.select(*mine.columns))
        _replace(after, path, None, buckets, number)

    log.finish(apply)
    with _staged(batch.withColumn(BUCKET, bucket), stored) as (rows, buckets):
        if not buckets:
            return log.write(None, apply, marks or {})
        table = read_or_none(spark, path)
        whole = rows if table is None else table
        if merged is None and keep is None:  # every batch row counts as it is: only the rows it replaces are looked up
            changes = rows.select(*whole.columns, F.lit("after").alias(CHANGE))
            if table is not None:
                other = rows.select(*[F.col(k).alias(f"__{k}") for k in keys])
                old = table.filter(F.col(BUCKET).isin(buckets)).join(other, _same(keys, "__"), "left_semi")
                changes = changes.unionByName(old.withColumn(CHANGE, F.lit("before")))
            return log.write(changes, apply, marks or {})
        row = F.struct(*[F.col(c) for c in whole.columns])
        new = rows.select(*[F.col(k).alias(f"__{k}") for k in keys], row.alias("n"))
        if table is None:
            paired = new.withColumn("o", F.lit(None).cast(new.schema["n"].dataType))
        else:
            old = table.filter(F.col(BUCKET).isin(buckets)).select(*keys, row.alias("o"))
            paired = new.join(old, _same(keys, "__"), "left")
        o, n = F.col("o"), F.col("n")
        if keep is not None:
            paired = paired.filter(o.isNull() | keep(o, n))
        after = F.when(n.isNotNull(), n if merged is None else merged(o, n))
        both = F.array(
            F.when(o.isNotNull(), F.struct(F.lit("before").alias(CHANGE), o.alias("v"))),
            F.when(after.isNotNull(), F.struct(F.lit("after").alias(CHANGE), after.alias("v"))),
        )
        changes = paired.select(F.explode(F.array_compact(both)).alias("c")).select("c.v.*", f"c.{CHANGE}")
        return log.write(changes, apply, marks or {})


@contextlib.contextmanager
def _staged(df: DataFrame, stored: bool = False) -> Iterator[tuple[DataFrame, list[int]]]:
    """``df`` as a table for the time of one block, and its buckets; as it is where it comes from ``stored`` files."""
    if stored:
        yield df, sorted(touched_buckets(df))
        return
    path = scratch_dir(df.sparkSession, "batch")
    try:
        yield _written(df, path)
    finally:
        delete_folder(df.sparkSession, path)


def upsert_logged(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    newer_by: Sequence[str] | None = None,
    marks: dict | None = None,
    stored: bool = False,
) -> int:
    """Upsert like ``tables.upsert_table``, leaving a feed of the rows that were replaced or added. Null keys are left out."""

    def rank(x: Column) -> Column:
        return F.struct(*[x.getField(c) for c in newer_by])

    keep = None if newer_by is None else lambda o, n: rank(n) >= rank(o)
    return merge_logged(spark, path, updates.dropna(subset=list(keys)), keys, bucket, None, marks, keep, stored)


def _replace(rows: DataFrame, path: str, state: str | None, buckets: list[int], number: int) -> None:
    """Rewrite the partitions of ``rows``; touched buckets that get no (open) rows any more are deleted.

    The rows of a bucket are brought together first, so that no task leaves a small file in each. A large write to few buckets
    has no need of that shuffle: what every task holds of a bucket is a file of good size.
    """
    changed = folder_bytes(rows.sparkSession, f"{path}/_changes/{number:010d}")
    gather = len(buckets) > FEW_BUCKETS or changed < LARGE_BYTES * len(buckets)
    columns = [BUCKET] if state is None else [STATE, BUCKET]
    mine = F.lit(True) if state is None else F.col(STATE) == state
    seen = Observation()
    replace_partitions(rows.observe(seen, F.collect_set(F.when(mine, F.col(BUCKET))).alias("buckets")), path, columns, gather, COMPRESSION)
    for b in set(buckets) - set(seen.get["buckets"]):
        delete_folder(rows.sparkSession, f"{path}/{'' if state is None else f'{STATE}={state}/'}{BUCKET}={b}")


def snapshot_logged(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    strategy: str,
    updated_at: str | None = None,
    check_cols: Sequence[str] = (),
    as_of: Column | None = None,
    refresh: Sequence[str] = (),
    hard_deletes: str = "ignore",
    marks: dict | None = None,
    stored: bool = False,
) -> int:
    """Type-2 history of a batch (at most one row per key) that logs the versions it opens, closes and refreshes.

    Only buckets with changed versions are rewritten; versions closed by one write lie in a partition of their own.
    A ``stored`` batch is not written first, as in :func:`merge_logged`.

    With ``hard_deletes="close"`` the batch is the whole population, and keys missing from it are closed at ``as_of``. A
    digest per bucket (rows, and two order-free sums of hashes of the keys and what opens a version) is compared with that of
    the batch before: buckets with the same digest hold neither changes nor deleted keys, and are not opened.
    """
    log = ChangeLog(spark, path)
    apply = functools.partial(_apply_versions, path, keys)
    log.finish(apply)
    with _staged(source.dropna(subset=list(keys)).withColumn(BUCKET, bucket), stored) as (batch, buckets):
        digest = None
        if hard_deletes == "close":
            digest = _digests(batch, [*keys, *([updated_at] if strategy == "timestamp" else check_cols)])
            known = log.marks().get("digests", {})
            buckets = [int(b) for b in {*digest, *known} if digest.get(b) != known.get(b)]
            batch = batch.filter(F.col(BUCKET).isin(buckets))
        marks = {**(marks or {}), **({} if digest is None else {"digests": digest})}
        if not buckets:
            return log.write(None, apply, marks)
        opened = _open_versions(spark, path, buckets)
        changes = scd2_changes(opened, batch, keys, strategy, updated_at, check_cols, as_of, hard_deletes, refresh)
        return log.write(changes, apply, marks)


def append_history_logged(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    updated_at: str,
    bucket: Column,
    marks: dict | None = None,
) -> int:
    """Type-2 history of a batch that may hold several changes of a key: each different ``updated_at`` is a version.

    Gives what applying the changes one after the other would give. Rows not newer than the key's open version are left out,
    and of rows with one key and time the one with the largest hash counts.
    """
    log = ChangeLog(spark, path)
    apply = functools.partial(_apply_versions, path, keys)
    log.finish(apply)
    one = dedup_latest(rows.dropna(subset=[*keys, updated_at]), [*keys, updated_at], [], null_keys="drop")
    with _staged(one.withColumn(BUCKET, bucket)) as (batch, buckets):
        if not buckets:
            return log.write(None, apply, marks or {})
        opened = _open_versions(spark, path, buckets)
        if opened is not None:
            old = opened.select(*keys, F.col("valid_from").alias("__since"))
            batch = batch.join(old, list(keys), "left")
            batch = batch.filter(F.col("__since").isNull() | (F.col(updated_at) > F.col("__since"))).drop("__since")
        versions = scd2_from_history(batch, keys, updated_at)
        changes = versions.withColumn(CHANGE, F.when(F.col("valid_to").isNull(), "opened").otherwise("passed"))
        if opened is not None:
            first = batch.groupBy(*keys).agg(F.min(updated_at).alias("__until"))
            shut = opened.join(first, list(keys)).withColumn("valid_to", F.col("__until")).drop("__until")
            changes = changes.select(*opened.columns, CHANGE).unionByName(shut.withColumn(CHANGE, F.lit("closed")))
        return log.write(changes, apply, marks or {})


def _open_versions(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame | None:
    table = read_or_none(spark, path)
    return None if table is None else table.filter(F.col(BUCKET).isin(buckets) & (F.col(STATE) == OPEN)).drop(STATE)


def _apply_versions(path: str, keys: Sequence[str], changes: DataFrame, buckets: list[int], number: int) -> None:
    ended = F.col(CHANGE).isin("closed", "passed")
    live = changes.filter(~ended).withColumn(STATE, F.lit(OPEN))
    shut = changes.filter(ended).withColumn(STATE, F.lit(f"write-{number:010d}"))
    after = live.unionByName(shut).drop(CHANGE, NUMBER)
    table = read_or_none(changes.sparkSession, path)
    if table is not None:
        mine = table.filter(F.col(BUCKET).isin(buckets) & (F.col(STATE) == OPEN))
        # a changed key's open version is among the changes, or there is none any more
        after = _without(mine, changes, keys).unionByName(after.select(*mine.columns))
    _replace(after, path, OPEN, buckets, number)


def _digests(batch: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """One short text per bucket: as many as the table has partitions."""
    row = F.xxhash64(*columns)
    other = F.xxhash64(F.lit(1), *columns).cast("decimal(20, 0)")
    sums = batch.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.sum(other).alias("s"))
    return {str(r[BUCKET]): f"{r.n}/{r.x}/{r.s}" for r in sums.collect()}


def rows_of_keys(table: DataFrame, wanted: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """Rows of ``table`` (with its bucket column) whose keys are ``wanted``; other buckets are not opened."""
    buckets = touched_buckets(wanted.select(bucket.alias(BUCKET)))
    return table.filter(F.col(BUCKET).isin(buckets)).join(wanted.select(*keys).distinct(), list(keys), "left_semi")
