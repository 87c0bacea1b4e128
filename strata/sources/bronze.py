"""Landed lines to bronze tables: payload text plus lineage columns, one partition per ingestion date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.schemas import BRONZE, LINEAGE, RESOURCES
from strata.sources.files import folder_bytes, path_exists

SUMMARY = "resource string, location string, n_rows bigint, n_bytes bigint, status string"
COLUMNS = (
    "_bronze_ingest_ts _source_file _raw_s3_uri _source_endpoint _ingestion_timestamp _extraction_run_id "
    "_payload_checksum _repo_full_name data _ingestion_date"
).split()


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """All lines below ``path``, one JSON document each."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def parse_bronze(raw: DataFrame, ingest_ts: Column, ingestion_date: str | None = None) -> DataFrame:
    """Bronze columns of landed lines. Each line is parsed once; the payload stays JSON text.

    ``ingestion_date`` is the date being loaded: every line goes into its partition, whatever date its lineage names,
    so that a stray line can't replace another date. Without it the partition is the lineage's date. A line that does
    not parse keeps its place with null columns and later fails its quality rules.
    """
    line = F.from_json("value", f"data string, lineage struct<{LINEAGE}>").alias("line")
    day = F.lit(ingestion_date) if ingestion_date else F.col("line.lineage.ingestion_date")
    lineage = {
        "_source_file": "source_s3_uri",
        "_raw_s3_uri": "source_s3_uri",
        "_source_endpoint": "source_endpoint",
        "_extraction_run_id": "extraction_run_id",
        "_payload_checksum": "payload_checksum",
        "_repo_full_name": "repo_full_name",
    }
    taken = {name: F.col(f"line.lineage.{field}") for name, field in lineage.items()}
    taken["_bronze_ingest_ts"] = ingest_ts
    taken["_ingestion_timestamp"] = F.col("line.lineage.ingestion_timestamp").try_cast("timestamp")
    taken["data"], taken["_ingestion_date"] = F.col("line.data"), day
    return raw.select(line).select(*[taken[name].alias(name) for name in COLUMNS])


def replace_partitions(
    df: DataFrame, path: str, partition_cols: Sequence[str], gather: bool = False, compression: str | None = None
) -> int:
    """Overwrite exactly the partitions present in ``df``; a rerun replaces, never appends. Returns rows written.

    The count comes from the write itself, not from a second pass. ``gather`` brings the rows of a partition
    together first, so that every task does not leave a small file in every partition; it is a rebalance, so AQE
    splits large partitions over several tasks and joins small ones.
    """
    seen = Observation()
    rows = df.hint("rebalance", *partition_cols) if gather else df
    (
        rows.observe(seen, F.count(F.lit(1)).alias("n_rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path, compression=compression)
    )
    return seen.get["n_rows"]


def register_external(spark: SparkSession, table: str, path: str) -> None:
    """Point a catalog table at ``path`` (no-op when it exists) and pick up its new partitions."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    if spark.table(table).columns and "_ingestion_date" in spark.table(table).columns:
        spark.catalog.recoverPartitions(table)


def read_bronze(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Bronze table by its declared columns: files written before a column existed give nulls, and no file has to
    be opened to find the schema. ``merge_schema`` asks the files instead, for columns that are not declared."""
    if merge_schema:
        merged = spark.read.option("mergeSchema", True).parquet(path)
        return merged.withColumn("_ingestion_date", F.col("_ingestion_date").cast("string"))
    return spark.read.schema(BRONZE).parquet(path)


def latest_partition(df: DataFrame, col: str, newest: str | None = None) -> DataFrame:
    """Rows of the newest value of a partition column.

    With ``newest`` known (see ``files.newest_partition``) the filter is a literal and prunes at planning time;
    otherwise it is a scalar subquery, which prunes at run time after a pass over the partition column.
    """
    return df.filter(F.col(col) == (df.agg(F.max(col)).scalar() if newest is None else F.lit(newest)))


def load_resource(
    spark: SparkSession, raw_path: str, bronze_path: str, ingestion_date: str, ingest_ts: Column
) -> int | None:
    """Load one resource's landed lines of a date; None when there is nothing to load (and nothing is touched)."""
    raw = scan_raw(spark, raw_path)
    if raw.isEmpty():
        return None
    lines = parse_bronze(raw, ingest_ts, ingestion_date)
    return replace_partitions(lines, bronze_path, ["_ingestion_date"], compression="zstd")


def load_all(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    ingestion_date: str,
    ingest_ts: Column,
    resources: Sequence[str] = RESOURCES,
    database: str | None = None,
) -> DataFrame:
    """Load every resource of a date, stop at the first failure, and return one summary row per resource."""
    summary = []
    for resource in resources:
        source, target = f"{raw_root}/{resource}/ingestion_date={ingestion_date}", f"{bronze_root}/{resource}"
        rows = load_resource(spark, source, target, ingestion_date, ingest_ts) if path_exists(spark, source) else None
        if rows is not None and database:
            register_external(spark, f"{database}.{resource}", target)
        written = 0 if rows is None else folder_bytes(spark, f"{target}/_ingestion_date={ingestion_date}")
        summary.append((resource, target, rows or 0, written, "SKIPPED" if rows is None else "OK"))
    return spark.createDataFrame(summary, SUMMARY)
