"""What must hold for the tables of a run, and the counts of rows that break it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.checks import check_one_current, check_relationship, check_unique

# table -> columns that are never null
# fixed values: the data tests a user of the tables relies on
NOT_NULL = {
    "staged/repositories": ["repository_id"],
    "staged/issues": ["issue_id", "updated_at"],
    "staged/pull_requests": ["pull_request_id", "updated_at"],
    "staged/pr_details": ["pull_request_id"],
    "staged/releases": ["release_id"],
    "staged/languages": ["language"],
    "validated/repositories": ["repository_id", "is_quarantined"],
    "validated/issues": ["issue_id", "is_quarantined"],
    "validated/pull_requests": ["pull_request_id", "is_quarantined"],
    "validated/releases": ["release_id", "is_quarantined"],
    "validated/languages": ["language", "is_quarantined"],
    "repositories_current": ["repository_id", "full_name", "is_quarantined"],
    "issues_current": ["issue_id", "repository_url", "is_quarantined"],
    "pull_requests_current": ["pull_request_id", "is_quarantined"],
    "releases": ["release_id", "tag_name", "is_quarantined"],
    "languages": ["language", "bytes", "is_quarantined"],
    "gold/dim_repositories": ["repository_sk", "repo_id"],
    "gold/dim_repositories_current": ["repository_sk", "repo_id"],
    "gold/dim_users": ["user_sk", "user_id"],
    "gold/fact_issues": ["issue_sk", "repository_sk", "author_user_sk"],
    "gold/fact_pull_requests": ["pull_request_sk", "repository_sk", "author_user_sk"],
    "gold/fact_releases": ["release_sk", "repository_sk", "author_user_sk"],
    "gold/kpi_repo_health": ["repo_id"],
    "gold/kpi_time_series": ["repo_id", "month_year"],
    "gold/kpi_user_contributions": ["user_id", "repo_id"],
    "gold/kpi_pr_complexity": ["pr_id"],
}

# table -> keys, each unique on its own. In the current views a key may show once clean and once quarantined.
UNIQUE = {
    "staged/repositories": [["repository_id"]],
    "staged/issues": [["issue_id"]],
    "staged/pull_requests": [["pull_request_id"]],
    "staged/pr_details": [["pull_request_id"]],
    "staged/releases": [["release_id"]],
    "validated/issues": [["issue_id"]],
    "validated/pull_requests": [["pull_request_id"]],
    "validated/releases": [["release_id"]],
    "repositories_current": [["repository_id", "is_quarantined"]],
    "issues_current": [["issue_id", "is_quarantined"]],
    "pull_requests_current": [["pull_request_id", "is_quarantined"]],
    "releases": [["release_id"]],
    "gold/dim_repositories": [["repository_sk"]],
    "gold/dim_repositories_current": [["repository_sk"]],
    "gold/dim_users": [["user_sk"], ["user_id"]],
    "gold/fact_issues": [["issue_sk"]],
    "gold/fact_pull_requests": [["pull_request_sk"]],
    "gold/fact_releases": [["release_sk"]],
    "gold/kpi_repo_health": [["repo_id"]],
    "gold/kpi_pr_complexity": [["pr_id"]],
}

# (child, key, parent, key)
RELATIONSHIPS = [
    (fact, key, parent, parent_key)
    for fact in ("gold/fact_issues", "gold/fact_pull_requests", "gold/fact_releases")
    for key, parent, parent_key in (
        ("repository_sk", "gold/dim_repositories_current", "repository_sk"),
        ("author_user_sk", "gold/dim_users", "user_sk"),
    )
]

ONE_CURRENT = {
    "history/repositories": "repository_id",
    "history/issues": "issue_id",
    "history/pull_requests": "pull_request_id",
}


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check over the given tables: check, table, columns and the number of violations.

    All null checks of a table are one scan of its columns; every other check is one counted frame.
    """
    found: list[DataFrame] = []

    def row(df: DataFrame, check: str, table: str, columns: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(columns).alias("columns"), "violations"
        )

    for name, df in tables.items():
        cols = NOT_NULL.get(name, [])
        if cols:
            nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
            each = F.array(*[F.struct(F.lit(c).alias("columns"), F.col(c).alias("violations")) for c in cols])
            found.append(
                nulls.select(F.inline(each)).select(
                    F.lit("not_null").alias("check"), F.lit(name).alias("table"), "columns", "violations"
                )
            )
        for keys in UNIQUE.get(name, []):
            found.append(row(check_unique(df, keys), "unique", name, ",".join(keys)))
        if name in ONE_CURRENT:
            found.append(row(check_one_current(df, [ONE_CURRENT[name]]), "one_current", name, ONE_CURRENT[name]))
    for child, key, parent, parent_key in RELATIONSHIPS:
        if child in tables and parent in tables:
            orphans = check_relationship(tables[child], key, tables[parent], parent_key)
            found.append(row(orphans, "relationships", child, key))
    return reduce(DataFrame.unionByName, found)
