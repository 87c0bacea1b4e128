"""The landing zone: lineage envelopes and NDJSON parts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.payloads import payload_checksum
from strata.functions.scalars import repo_slug
from strata.schemas import PR_DETAIL_NODE
from strata.session import scratch_dir, setting
from strata.sources.files import folder_files, mounted_path, names
from strata.sources.parts import write_parts

SMALL_PART = 5_000  # lines; above it the cost of a file is small beside that of its lines
MOUNTED_OPEN = "64k"  # what could be read while a file is opened
LISTED = 100_000  # parts that the driver lists at a time, some 1.5 KB each


def wrap_envelope(
    df: DataFrame,
    run_id: str,
    endpoint: str | Column,
    ingestion_date: str | Column,
    repo: Column,
    uri: str | Column,
    as_of: Column,
    http_status: int = 200,
    rate_limit_remaining: int | None = None,
    payload: Sequence[str] | None = None,
    gather: bool = False,
) -> DataFrame:
    """One JSON line per record: ``{"data": record, "lineage": {...}}``, plus the columns that place the file.

    ``gather`` brings the records of a folder together and in order before they become lines, which are many times as long.
    """
    payload = list(payload or df.columns)

    def text(v: str | Column) -> Column:
        return F.lit(v) if isinstance(v, str) else v

    day, slug = text(ingestion_date), repo_slug(repo)
    if gather:
        df = df.withColumns({"__day": day, "__slug": slug})
        df = df.hint("rebalance", "__day", "__slug").sortWithinPartitions("__day", "__slug")
        day, slug = F.col("__day"), F.col("__slug")

    lineage = F.struct(
        F.lit(run_id).alias("extraction_run_id"),
        F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("ingestion_timestamp"),
        text(ingestion_date).alias("ingestion_date"),
        text(endpoint).alias("source_endpoint"),
        F.lit(http_status).alias("http_status"),
        F.lit(rate_limit_remaining).cast("int").alias("api_rate_limit_remaining"),
        F.lit(1).alias("record_count"),
        payload_checksum(payload).alias("payload_checksum"),
        text(uri).alias("source_s3_uri"),
        repo.alias("repo_full_name"),
    )
    body = F.struct(F.struct(*payload).alias("data"), lineage.alias("lineage"))
    return df.select(
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        day.alias("ingestion_date"),
        slug.alias("repo_slug"),
    )


def write_raw(df: DataFrame, path: str, max_records: int = 500_000, gathered: bool = False) -> None:
    """Land enveloped lines under ``ingestion_date=D/repo_slug=R``, at most ``max_records`` per part.

    A rerun replaces the folders it writes. The rebalance brings a repository's lines together to avoid small
    files, and AQE splits a repository that is far larger than the rest over several tasks. Lines enveloped with ``gather`` are together already (``gathered``).
    Small parts on a mounted file system are written by :mod:`strata.sources.parts`, without Hadoop's cost per file.
    """
    lines = df if gathered else df.hint("rebalance", "ingestion_date", "repo_slug")
    mounted = mounted_path(df.sparkSession, path) if max_records <= SMALL_PART else None
    if mounted:
        write_parts(lines if gathered else lines.sortWithinPartitions("ingestion_date", "repo_slug"), mounted, max_records)
        return
    (
        lines.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy("ingestion_date", "repo_slug")
        .text(path)
    )


def part_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed part: its lines (``n``) beside the columns of its folder.

    Parts are read whole, so they should be small; that costs less a file than the text reader and needs no grouping by
    file. An empty part gives no row. On a mounted file system opening a file is cheap, so that a task takes hundreds
    of parts; Spark's own estimate is made for remote ones and gives it 4 to 32. Dates are read a few at a time, since
    the driver lists every part of a read.
    """
    text = F.col("content").cast("string")
    ends = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    unended = ~F.endswith(text, F.lit("\n"))
    rows = [F.col(c).cast("string").alias(c) for c in ("ingestion_date", "repo_slug")] + [(ends + unended.cast("int")).alias("n")]
    dates = [f"{path}/{name}" for name in names(spark, path) if name.startswith("ingestion_date=")]
    out = scratch_dir(spark, "part-lines")
    cheap = setting(spark, "spark.sql.files.openCostInBytes", MOUNTED_OPEN) if mounted_path(spark, path) else nullcontext()
    with cheap:
        for some in _few_parts(spark, dates):
            parts = spark.read.option("basePath", path).format("binaryFile").load(some)
            parts.select(*rows).write.mode("append").parquet(out)
    schema = "ingestion_date string, repo_slug string, n int"
    return spark.read.schema(schema).parquet(out) if dates else spark.createDataFrame([], schema)


def _few_parts(spark: SparkSession, folders: Sequence[str]) -> Iterator[list[str]]:
    """Folders in groups of at most ``LISTED`` files, or of one folder that has more."""
    some, held = [], 0
    for folder in folders:
        files = folder_files(spark, folder)
        if some and held + files > LISTED:
            yield some
            some, held = [], 0
        some, held = [*some, folder], held + files
    if some:
        yield some


def normalize_pr_details(df: DataFrame, col: str) -> DataFrame:
    """Nested pull-request nodes to flat detail records; null or unparsable nodes are dropped."""
    node = df.select(F.from_json(col, PR_DETAIL_NODE).alias("n")).filter(
        F.col("n.databaseId").isNotNull() | F.col("n.number").isNotNull()
    )
    return node.select(
        F.col("n.databaseId").alias("id"),
        F.col("n.number").alias("number"),
        F.col("n.additions").alias("additions"),
        F.col("n.deletions").alias("deletions"),
        F.col("n.changedFiles").alias("changed_files"),
        F.col("n.commits.totalCount").alias("commits"),
        F.col("n.reviewThreads.totalCount").alias("review_comments"),
    )
