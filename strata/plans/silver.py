"""Current-state views over history and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.scd2 import current_view
from strata.plans.staging import DETAIL_MEASURES, INGEST, RUN

ENTITY = ["title", "state", "user_id", "user_login", "created_at", "updated_at", "closed_at"]

ISSUE_COLUMNS = [
    "issue_id", "issue_number", *ENTITY, "comments_count", "repository_url", "repository_id", "labels", INGEST, RUN,
]
PULL_REQUEST_COLUMNS = [
    "pull_request_id", "pr_number", *ENTITY, "merged_at", "merge_commit_sha", "is_draft", "head_branch",
    "base_branch", *DETAIL_MEASURES, INGEST, RUN,
]
REPOSITORY_COLUMNS = [
    "repository_id", "full_name", "owner_login", "repo_name", "description", "primary_language", "stars", "forks",
    "watchers", "open_issues", "default_branch", "is_fork", "is_archived", "created_at", "updated_at", "pushed_at",
    "repo_size_kb", "topics", "license", INGEST, RUN, "_ingestion_date",
]
RELEASE_COLUMNS = [
    "release_id", "tag_name", "release_name", "is_draft", "is_prerelease", "author_id", "author_login", "created_at",
    "published_at", "target_commitish", INGEST, RUN, "_ingestion_date", "_repo_full_name", "repository_id",
    "dq_failed_rules", "is_quarantined",
]
LANGUAGE_COLUMNS = [
    "repository_id", "repo_full_name", "language", "bytes", INGEST, "_ingestion_date", "dq_failed_rules",
    "is_quarantined",
]

# repository changes that open a new version; anything else (such as the last push) does not
REPOSITORY_CHECK_COLUMNS = ["stars", "forks", "watchers", "open_issues", "description", "primary_language"]


def issues_current(history: DataFrame, validated: DataFrame) -> DataFrame:
    return current_view(history, validated, ISSUE_COLUMNS, extra="not is_pull_request")


def pull_requests_current(history: DataFrame, validated: DataFrame) -> DataFrame:
    return current_view(history, validated, PULL_REQUEST_COLUMNS)


def repositories_current(history: DataFrame, validated: DataFrame) -> DataFrame:
    return current_view(history, validated, REPOSITORY_COLUMNS)
