"""Bronze payload text to typed, deduplicated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.payloads import explode_map, flatten_json, parsed_timestamp
from strata.operators.dedup import dedup_latest
from strata.sources.bronze import latest_partition

INGEST = "_bronze_ingest_ts"
RUN = "_extraction_run_id"


def _ts(*names: str) -> dict:
    return {n: parsed_timestamp(n) for n in names}


REPOSITORY_FIELDS = {
    "repository_id": "id",
    "owner_login": "owner.login",
    "repo_name": "name",
    "description": "description",
    "primary_language": "language",
    "stars": "stargazers_count",
    "forks": "forks_count",
    "watchers": "watchers_count",
    "open_issues": "open_issues_count",
    "default_branch": "default_branch",
    "is_fork": "fork",
    "is_archived": "archived",
    "repo_size_kb": "size",
    "topics": "topics",
    "license": "license.spdx_id",
}

ISSUE_FIELDS = {
    "issue_id": "id",
    "issue_number": "number",
    "title": "title",
    "state": "state",
    "user_id": "user.id",
    "user_login": "user.login",
    "comments_count": "comments",
    "repository_url": "repository_url",
    "labels": "labels",
}

PULL_REQUEST_FIELDS = {
    "pull_request_id": "id",
    "pr_number": "number",
    "title": "title",
    "state": "state",
    "user_id": "user.id",
    "user_login": "user.login",
    "merge_commit_sha": "merge_commit_sha",
    "is_draft": "draft",
    "head_branch": "head.ref",
    "base_branch": "base.ref",
    "canonical_repo_name": "base.repo.full_name",
}

PR_DETAIL_FIELDS = {
    "pull_request_id": "id",
    "pr_number": "number",
    "additions": "additions",
    "deletions": "deletions",
    "commits_count": "commits",
    "changed_files": "changed_files",
    "review_comments_count": "review_comments",
}

RELEASE_FIELDS = {
    "release_id": "id",
    "tag_name": "tag_name",
    "release_name": "name",
    "is_draft": "draft",
    "is_prerelease": "prerelease",
    "author_id": "author.id",
    "author_login": "author.login",
    "target_commitish": "target_commitish",
}

DETAIL_MEASURES = ("additions", "deletions", "commits_count", "changed_files", "review_comments_count")


def stage_repositories(bronze: DataFrame, newest_date: str | None = None) -> DataFrame:
    """Newest full population; the envelope's repository name is the full name."""
    fields = {**REPOSITORY_FIELDS, **_ts("created_at", "updated_at", "pushed_at")}
    keep = [F.col("_repo_full_name").alias("full_name"), INGEST, RUN, "_ingestion_date"]
    newest = latest_partition(bronze, "_ingestion_date", newest_date)
    typed = flatten_json(newest, "data", schemas.REPOSITORY, fields, keep)
    return dedup_latest(typed, ["repository_id"], ["updated_at", INGEST])


def type_issues(bronze: DataFrame) -> DataFrame:
    fields = {
        **ISSUE_FIELDS,
        **_ts("created_at", "updated_at", "closed_at"),
        "is_pull_request": F.col("payload.pull_request").isNotNull(),
    }
    keep = [
        F.col("_repo_full_name").alias("repo_full_name"),
        F.col("_ingestion_timestamp").alias("ingestion_timestamp"),
        INGEST,
        RUN,
    ]
    return flatten_json(bronze, "data", schemas.ISSUE, fields, keep)


def stage_issues(bronze: DataFrame) -> DataFrame:
    return dedup_latest(type_issues(bronze), ["issue_id"], ["updated_at", INGEST])


def type_pull_requests(bronze: DataFrame) -> DataFrame:
    fields = {**PULL_REQUEST_FIELDS, **_ts("created_at", "updated_at", "closed_at", "merged_at")}
    keep = [
        F.col("_repo_full_name").alias("repo_full_name"),
        F.col("_ingestion_timestamp").alias("ingestion_timestamp"),
        INGEST,
        RUN,
    ]
    return flatten_json(bronze, "data", schemas.PULL_REQUEST, fields, keep)


def stage_pull_request_heads(bronze: DataFrame) -> DataFrame:
    return dedup_latest(type_pull_requests(bronze), ["pull_request_id"], ["updated_at", INGEST])


def type_pr_details(bronze: DataFrame) -> DataFrame:
    keep = [F.col("_ingestion_timestamp").alias("ingestion_timestamp"), INGEST, RUN]
    return flatten_json(bronze, "data", schemas.PR_DETAIL, PR_DETAIL_FIELDS, keep)


def stage_pr_details(bronze: DataFrame) -> DataFrame:
    return dedup_latest(type_pr_details(bronze), ["pull_request_id"], [INGEST])


def enrich_pull_requests(heads: DataFrame, details: DataFrame) -> DataFrame:
    """Size measures onto pull requests. The row counts as new when either side is, so that details arriving a
    day after an unchanged pull request still reach it."""
    measures = details.select(
        F.col("pull_request_id").alias("__pr"), *DETAIL_MEASURES, F.col(INGEST).alias("__detail_ts")
    )
    joined = heads.join(measures, F.col("pull_request_id") == F.col("__pr"), "left")
    newest = F.greatest(INGEST, "__detail_ts")
    return joined.withColumn(INGEST, newest).drop("__pr", "__detail_ts")


def stage_pull_requests(pr_bronze: DataFrame, detail_bronze: DataFrame) -> DataFrame:
    return enrich_pull_requests(stage_pull_request_heads(pr_bronze), stage_pr_details(detail_bronze))


def type_releases(bronze: DataFrame) -> DataFrame:
    fields = {**RELEASE_FIELDS, **_ts("created_at", "published_at")}
    return flatten_json(bronze, "data", schemas.RELEASE, fields, [INGEST, RUN, "_ingestion_date", "_repo_full_name"])


def stage_releases(bronze: DataFrame, newest_date: str | None = None) -> DataFrame:
    newest = latest_partition(bronze, "_ingestion_date", newest_date)
    return dedup_latest(type_releases(newest), ["release_id"], [INGEST])


def stage_languages(bronze: DataFrame, newest_date: str | None = None) -> DataFrame:
    newest = latest_partition(bronze, "_ingestion_date", newest_date)
    cols = newest.select(F.col("_repo_full_name").alias("repo_full_name"), INGEST, "_ingestion_date", "data")
    return explode_map(cols, "data", "language", "bytes").select(
        "repo_full_name", "language", "bytes", INGEST, "_ingestion_date"
    )
