"""Star schema: dimensions and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import date_key, day_of_key, hours_between, surrogate_key
from strata.operators.dedup import dedup_latest
from strata.operators.joins import resolve_reference
from strata.operators.scd2 import scd2_current, version_dimension
from strata.operators.spine import date_dim
from strata.plans.staging import INGEST, RUN

UPDATED = "_gold_update_ts"
FALLBACK_START = "2024-01-01"


def calendar_bounds(
    fact_issues: DataFrame, fact_prs: DataFrame, last_day: Column | None = None, legacy: bool = False
) -> DataFrame:
    """First and last calendar day as one row, from one pass over the date keys.

    The first is the earliest creation day of issues and pull requests; ``legacy`` looks at issues only, which
    drops older pull requests from the monthly series. The last is ``last_day``, or the latest milestone.
    """
    none = F.lit(None).cast("int")
    issues = fact_issues.select(
        F.col("created_date_key").alias("k"), F.greatest("created_date_key", "closed_date_key").alias("latest")
    )
    prs = fact_prs.select(
        (none if legacy else F.col("created_date_key")).alias("k"),
        F.greatest("created_date_key", "merged_date_key", "closed_date_key").alias("latest"),
    )
    ends = issues.unionByName(prs).agg(F.min("k").alias("k"), F.max("latest").alias("latest"))
    return ends.select(
        F.coalesce(day_of_key("k"), F.lit(FALLBACK_START).cast("date")).alias("start"),
        (day_of_key("latest") if last_day is None else last_day.cast("date")).alias("end"),
    )


def calendar(bounds: DataFrame) -> DataFrame:
    return date_dim(bounds)


def dim_repositories(history: DataFrame, as_of: Column) -> DataFrame:
    columns = {
        "repository_sk": "scd_id",
        "repo_id": "repository_id",
        "repo_name": "full_name",
        "owner_login": "owner_login",
        "primary_language": "primary_language",
        "license_name": "license",
        INGEST: INGEST,
        RUN: RUN,
    }
    return version_dimension(history, columns).withColumn(UPDATED, as_of)


def dim_repositories_current(history: DataFrame, as_of: Column) -> DataFrame:
    return scd2_current(history).select(
        surrogate_key("repository_id").alias("repository_sk"),
        F.col("repository_id").alias("repo_id"),
        F.col("full_name").alias("repo_name"),
        "owner_login",
        "primary_language",
        F.col("license").alias("license_name"),
        INGEST,
        RUN,
        as_of.alias(UPDATED),
    )


def dim_users(
    issues: DataFrame, prs: DataFrame, releases: DataFrame, as_of: Column, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Newest known login of every user seen on a clean issue, pull request or release."""

    def people(df: DataFrame, who: str, login: str) -> DataFrame:
        return df.filter("not is_quarantined").select(
            F.col(who).alias("user_id"), F.col(login).alias("user_login"), INGEST, RUN
        )

    seen = (
        people(issues, "user_id", "user_login")
        .unionByName(people(prs, "user_id", "user_login"))
        .unionByName(people(releases, "author_id", "author_login"))
        .filter(F.col("user_login").isNotNull())
    )
    # a login without an id cannot be joined to any fact
    newest = dedup_latest(seen, ["user_id"], [INGEST], tie_break=tie_break, null_keys="drop")
    return newest.select(
        surrogate_key("user_id").alias("user_sk"),
        "user_id",
        "user_login",
        F.lit("User").alias("user_type"),
        INGEST,
        RUN,
        as_of.alias(UPDATED),
    )


def with_repository_sk(df: DataFrame, repos: DataFrame) -> DataFrame:
    return resolve_reference(df, repos, "repository_id", "repo_id", ["repository_sk"])


def fact_issues(history: DataFrame, repos: DataFrame, as_of: Column) -> DataFrame:
    """One row per issue with its milestones; pull requests that the API lists as issues are left out."""
    rows = scd2_current(history).filter("not is_pull_request")
    return with_repository_sk(rows, repos).select(
        surrogate_key("issue_id").alias("issue_sk"),
        "repository_sk",
        surrogate_key("user_id").alias("author_user_sk"),
        "issue_id",
        F.col("repository_id").alias("repo_id"),
        F.col("user_id").alias("author_user_id"),
        date_key("created_at").alias("created_date_key"),
        date_key("closed_at").alias("closed_date_key"),
        "state",
        hours_between("created_at", "closed_at").alias("time_to_close_hours"),
        F.col("comments_count").alias("comment_count"),
        "updated_at",
        INGEST,
        RUN,
        as_of.alias(UPDATED),
    )


def fact_pull_requests(history: DataFrame, repos: DataFrame, as_of: Column) -> DataFrame:
    return with_repository_sk(scd2_current(history), repos).select(
        surrogate_key("pull_request_id").alias("pull_request_sk"),
        "repository_sk",
        surrogate_key("user_id").alias("author_user_sk"),
        F.col("pull_request_id").alias("pr_id"),
        F.col("repository_id").alias("repo_id"),
        F.col("user_id").alias("author_user_id"),
        date_key("created_at").alias("created_date_key"),
        date_key("merged_at").alias("merged_date_key"),
        date_key("closed_at").alias("closed_date_key"),
        "state",
        hours_between("created_at", "merged_at").alias("time_to_merge_hours"),
        hours_between("created_at", "closed_at").alias("time_to_close_hours"),
        F.col("review_comments_count").alias("comment_count"),
        "additions",
        "deletions",
        "changed_files",
        "commits_count",
        "updated_at",
        INGEST,
        RUN,
        as_of.alias(UPDATED),
    )


def fact_releases(releases: DataFrame, repos: DataFrame, as_of: Column) -> DataFrame:
    return with_repository_sk(releases.filter("not is_quarantined"), repos).select(
        surrogate_key("release_id").alias("release_sk"),
        "repository_sk",
        surrogate_key("author_id").alias("author_user_sk"),
        "release_id",
        F.col("author_id").alias("author_user_id"),
        date_key("published_at").alias("published_date_key"),
        "tag_name",
        "is_prerelease",
        INGEST,
        RUN,
        as_of.alias(UPDATED),
    )
