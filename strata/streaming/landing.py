"""The same loads as file streams: each start takes what has landed since the last one, then stops.

Progress lives in the stream's checkpoint instead of a watermark table. The operators are the batch ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.dedup import dedup_latest
from strata.schemas import BRONZE
from strata.sources.bronze import parse_bronze
from strata.sources.changes import ChangeLog, append_history_logged
from strata.sources.tables import upsert_table


def follow_raw(spark: SparkSession, raw_path: str, bronze_path: str, checkpoint: str) -> StreamingQuery:
    """Landed lines into a bronze table, each line once.

    A stream has no date of its own to load: lines go by their lineage's date, unparsable ones into the null partition.
    Its folder belongs to the stream, whose log tells readers which files count; don't replace partitions in it.
    """
    lines = spark.readStream.option("recursiveFileLookup", True).text(raw_path)
    return (
        parse_bronze(lines, F.current_timestamp())
        .writeStream.format("parquet")
        .partitionBy("_ingestion_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(bronze_path)
    )


def follow_bronze(
    spark: SparkSession,
    bronze_path: str,
    table_path: str,
    checkpoint: str,
    typed: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
) -> StreamingQuery:
    """New bronze rows into a keyed table, newest row per key. A repeated batch merges to the same table."""

    def merge(batch: DataFrame, _: int) -> None:
        newest = dedup_latest(typed(batch), keys, order, null_keys="drop")
        upsert_table(spark, table_path, newest, keys, bucket, newer_by=order)

    return (
        spark.readStream.schema(BRONZE)
        .parquet(bronze_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_history(
    spark: SparkSession,
    bronze_path: str,
    table_path: str,
    checkpoint: str,
    typed: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    updated_at: str,
    bucket: Column,
) -> StreamingQuery:
    """New bronze rows into a type-2 table, with a version for each different ``updated_at`` of a key.

    The number of the micro-batch is a mark of the table's write: a batch that Spark repeats after a failure is known by it and
    neither doubles nor loses a version. (A write that stopped half-way is finished by the next one.)
    """

    def merge(batch: DataFrame, number: int) -> None:
        add_versions(spark, table_path, typed(batch), keys, updated_at, bucket, number)

    return (
        spark.readStream.schema(BRONZE)
        .parquet(bronze_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def add_versions(
    spark: SparkSession,
    table_path: str,
    rows: DataFrame,
    keys: Sequence[str],
    updated_at: str,
    bucket: Column,
    number: int,
) -> None:
    """One micro-batch into a type-2 table; a number that the table has taken already changes nothing."""
    if ChangeLog(spark, table_path).marks().get("batch", -1) < number:
        append_history_logged(spark, table_path, rows, keys, updated_at, bucket, {"batch": number})
