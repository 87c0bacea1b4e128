"""Loaded rows against expected volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: expected issues and pull requests of the repositories followed
EXPECTED_VOLUMES = (
    ("duckdb/duckdb", 22_000, 14_000),
    ("apache/spark", 45_000, 42_000),
    ("dbt-labs/dbt-core", 7_000, 6_000),
    ("facebook/react", 14_000, 16_000),
    ("langchain-ai/langchain", 8_000, 15_000),
    ("kubernetes/kubernetes", 60_000, 100_000),
    ("rust-lang/rust", 60_000, 70_000),
    ("microsoft/vscode", 170_000, 25_000),
)


def expected_volumes(spark) -> DataFrame:
    return spark.createDataFrame(EXPECTED_VOLUMES, "repo string, est_issues bigint, est_prs bigint").select(
        "repo", F.expr("stack(2, 'issues', est_issues, 'pull_requests', est_prs) as (resource, expected)")
    )


def load_vs_estimate(loaded: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows loaded per (repo, resource) beside the expected number; the share is null without an estimate."""
    counts = loaded.groupBy("repo", "resource").agg(F.count(F.lit(1)).alias("loaded"))
    return counts.join(expected, ["repo", "resource"], "full_outer").select(
        "repo",
        "resource",
        F.coalesce("loaded", F.lit(0)).alias("loaded"),
        "expected",
        (F.coalesce("loaded", F.lit(0)) / F.nullif("expected", F.lit(0))).alias("loaded_share"),
    )
