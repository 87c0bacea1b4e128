"""Report queries over the KPI tables. ``repo`` narrows a report to one repository; None means all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import contributor_label, short_name
from strata.operators.quantiles import exact_quantile, histogram, quantile_trim, value_counts
from strata.operators.ranking import top_k
from strata.operators.spine import zero_fill
from strata.plans.kpis import COUNTERS, SIZE_ORDER
from strata.session import written

MEDIANS = ("median_time_to_close_hours", "median_time_to_merge_hours")


def for_repo(df: DataFrame, repo: str | None = None) -> DataFrame:
    return df if repo is None else df.filter(F.col("repo_name") == F.lit(repo))


# -- data getters ---------------------------------------------------------------------------------------------


def repo_health(health: DataFrame, repo: str | None = None) -> DataFrame:
    return for_repo(health, repo).orderBy(F.col("repo_name").asc_nulls_last())


def time_series(series: DataFrame, repo: str | None = None) -> DataFrame:
    return for_repo(series, repo).orderBy(F.col("month_year").asc_nulls_last(), "repo_id")


def user_contributions(users: DataFrame, repo: str | None = None) -> DataFrame:
    """Most merged pull requests plus opened issues first."""
    score = F.col("total_prs_merged") + F.col("total_issues_opened")
    return for_repo(users, repo).orderBy(score.desc_nulls_last(), "repo_id", "user_id")


def pr_complexity(prs: DataFrame, repo: str | None = None) -> DataFrame:
    return for_repo(prs, repo).orderBy(F.col("total_lines_changed").desc_nulls_last(), "pr_id")


def repo_list(health: DataFrame) -> DataFrame:
    return health.select("repo_name").distinct().orderBy(F.col("repo_name").asc_nulls_last())


# -- repository health ----------------------------------------------------------------------------------------


def portfolio(health: DataFrame, repo: str | None = None) -> DataFrame:
    """Totals over repositories; the time columns are means of the repositories' medians."""
    return for_repo(health, repo).agg(
        F.sum("total_issues").alias("total_issues"),
        F.sum("open_issues").alias("open_issues"),
        F.sum("total_prs").alias("total_prs"),
        F.sum("open_prs").alias("open_prs"),
        F.avg(MEDIANS[0]).alias("avg_median_close_hours"),
        F.avg(MEDIANS[1]).alias("avg_median_merge_hours"),
        F.sum("approximate_total_contributors").alias("community_members"),
        F.count(F.lit(1)).alias("repositories"),
    )


def repo_workload(health: DataFrame, repo: str | None = None) -> DataFrame:
    """Open against closed work and members per repository, fewest members first."""
    return (
        for_repo(health, repo)
        .select(
            short_name("repo_name").alias("short_name"),
            (F.col("total_issues") - F.col("open_issues")).alias("closed_issues"),
            "open_issues",
            (F.col("total_prs") - F.col("open_prs")).alias("closed_prs"),
            "open_prs",
            "approximate_total_contributors",
        )
        .orderBy("approximate_total_contributors", "short_name")
    )


# -- trends ---------------------------------------------------------------------------------------------------


def active_months(series: DataFrame, repo: str | None = None) -> DataFrame:
    return for_repo(series, repo).filter(" or ".join(f"{c} > 0" for c in COUNTERS))


def monthly_rollup(series: DataFrame) -> DataFrame:
    """All repositories together per active month: counters summed, medians averaged."""
    return (
        active_months(series)
        .groupBy("month_year")
        .agg(*[F.sum(c).alias(c) for c in COUNTERS], *[F.avg(m).alias(m) for m in MEDIANS])
    )


def trend_totals(series: DataFrame, repo: str | None = None) -> DataFrame:
    return active_months(series, repo).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])


def issues_by_repo(series: DataFrame) -> DataFrame:
    """Opened issues per repository and active month; empty when only one repository is active."""
    active = active_months(series)
    several = active.agg(F.count_distinct("repo_name") > 1).scalar()
    return active.filter(several).select("month_year", short_name("repo_name").alias("short_name"), "issues_opened")


# -- change complexity ----------------------------------------------------------------------------------------


def pr_summary(prs: DataFrame, repo: str | None = None) -> DataFrame:
    chosen = for_repo(prs, repo)
    merged = chosen.filter(F.col("merged_date_key").isNotNull())
    median = exact_quantile(merged, [], "time_to_merge_hours", 0.5, "m").scalar()
    return chosen.agg(
        F.count(F.lit(1)).alias("total_prs"),
        F.count("merged_date_key").alias("merged_prs"),
        F.avg("total_lines_changed").alias("avg_lines_changed"),
    ).withColumn("median_merge_hours", median)


def size_distribution(prs: DataFrame, repo: str | None = None) -> DataFrame:
    counts = for_repo(prs, repo).groupBy("pr_size_bucket").agg(F.count(F.lit(1)).alias("n_prs"))
    return zero_fill(counts, SIZE_ORDER, "pr_size_bucket", "n_prs")


def lines_vs_merge_time(prs: DataFrame, repo: str | None = None, p: float = 0.99) -> DataFrame:
    """Merged pull requests up to the ``p`` quantile of merge time."""
    merged = for_repo(prs, repo).filter(F.col("merged_date_key").isNotNull())
    return quantile_trim(merged, "time_to_merge_hours", p).select(
        "pr_id", "total_lines_changed", "time_to_merge_hours", "pr_size_bucket", "changed_files", "commits_count"
    )


def files_histogram(prs: DataFrame, repo: str | None = None, p: float = 0.95, bins: int = 40) -> DataFrame:
    """Changed files per pull request up to the ``p`` quantile.

    Bound, range and bins only depend on how often each value occurs, so the pull requests are read once.
    """
    counts = written(value_counts(for_repo(prs, repo), "changed_files"), "file-counts")
    kept = quantile_trim(counts, "changed_files", p, weight="n_rows")
    return histogram(kept, "changed_files", bins, weight="n_rows")


# -- community ------------------------------------------------------------------------------------------------


def community_totals(users: DataFrame, repo: str | None = None) -> DataFrame:
    return for_repo(users, repo).agg(
        F.count_distinct("user_id").alias("unique_members"),
        F.sum("total_prs_merged").alias("prs_merged"),
        F.sum("total_issues_opened").alias("issues_opened"),
        F.sum("total_comments").alias("total_comments"),
    )


def leaderboard(users: DataFrame, repo: str | None = None, k: int = 10) -> DataFrame:
    score = F.col("total_prs_merged") + F.col("total_issues_opened")
    return top_k(for_repo(users, repo), score, k, ["repo_id", "user_id"]).select(
        F.col("github_username").alias("User"),
        short_name("repo_name").alias("Repository"),
        F.col("total_prs_merged").alias("PRs Merged"),
        F.col("total_issues_opened").alias("Issues"),
        F.col("total_comments").alias("Comments"),
        F.col("total_additions").alias("Lines Added"),
        F.col("total_deletions").alias("Lines Deleted"),
    )


def _top_by(users: DataFrame, measure: str, repo: str | None, k: int) -> DataFrame:
    best = top_k(for_repo(users, repo), measure, k, ["repo_id", "user_id"])
    return best.select(contributor_label("github_username", "repo_name").alias("label"), measure)


def top_merged(users: DataFrame, repo: str | None = None, k: int = 10) -> DataFrame:
    return _top_by(users, "total_prs_merged", repo, k)


def top_additions(users: DataFrame, repo: str | None = None, k: int = 10) -> DataFrame:
    return _top_by(users, "total_additions", repo, k)
