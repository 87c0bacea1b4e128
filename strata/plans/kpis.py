"""KPI tables over the star schema.

Issues and pull requests are stacked into one narrow stream per table and aggregated together, so each KPI costs
one shuffle of pre-combined counts instead of one aggregate and one join per measure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import date_key, month_of_key, ratio
from strata.operators.quantiles import quantile_of_counts, value_counts
from strata.operators.spine import densify
from strata.session import written


def current_repos(dim_repositories: DataFrame) -> DataFrame:
    return dim_repositories.filter("is_current").select("repo_id", "repo_name")


def _when(kind: str, value: Column) -> Column:
    return F.when(F.col("kind") == kind, value)


def _medians(counts: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """Median hours per key and kind, one column per kind, from how often each number of hours occurs."""
    long = quantile_of_counts(counts, [*keys, "kind"], "hours", 0.5, "median_hours")
    return long.groupBy(*keys).agg(*[F.max(_when(k, F.col("median_hours"))).alias(n) for k, n in names.items()])


def work_items(fact_issues: DataFrame, fact_prs: DataFrame) -> DataFrame:
    """Issues and pull requests as one narrow stream: repository, author, kind, state and hours until done."""

    def narrow(df: DataFrame, kind: str, hours: str) -> DataFrame:
        return df.select("repo_id", "author_user_id", F.lit(kind).alias("kind"), "state", F.col(hours).alias("hours"))

    return narrow(fact_issues, "issue", "time_to_close_hours").unionByName(narrow(fact_prs, "pr", "time_to_merge_hours"))


def health_counts(per_author: DataFrame) -> DataFrame:
    """Totals per repository from rows (repo_id, kind, author_user_id, n, n_open), each author once per kind."""
    return per_author.groupBy("repo_id").agg(
        F.sum(_when("issue", F.col("n"))).alias("n_issues"),
        F.sum(_when("issue", F.col("n_open"))).alias("n_open_issues"),
        F.count(_when("issue", F.col("author_user_id"))).alias("issue_authors"),
        F.sum(_when("pr", F.col("n"))).alias("n_prs"),
        F.sum(_when("pr", F.col("n_open"))).alias("n_open_prs"),
        F.count(_when("pr", F.col("author_user_id"))).alias("pr_authors"),
    )


def health_medians(counts: DataFrame) -> DataFrame:
    """Both medians per repository from rows (repo_id, kind, hours, n_rows)."""
    return _medians(counts, ["repo_id"], {"issue": "median_time_to_close_hours", "pr": "median_time_to_merge_hours"})


def health_rows(dim_repositories: DataFrame, measured: DataFrame) -> DataFrame:
    """The KPI's rows from counts and medians per repository."""

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    return current_repos(dim_repositories).join(measured, "repo_id", "left").select(
        "repo_id",
        "repo_name",
        zero("n_issues").alias("total_issues"),
        zero("n_open_issues").alias("open_issues"),
        "median_time_to_close_hours",
        zero("n_prs").alias("total_prs"),
        zero("n_open_prs").alias("open_prs"),
        "median_time_to_merge_hours",
        # the names are kept although the values are closed / all and not-open / all
        ratio(F.col("n_issues") - zero("n_open_issues"), "n_issues").alias("closed_to_open_issue_ratio"),
        ratio(F.col("n_prs") - zero("n_open_prs"), "n_prs").alias("merged_pr_ratio"),
        (zero("issue_authors") + zero("pr_authors")).alias("approximate_total_contributors"),
    )


def kpi_repo_health(fact_issues: DataFrame, fact_prs: DataFrame, dim_repositories: DataFrame) -> DataFrame:
    """Totals, open counts, medians and ratios per current repository, also for those without activity.

    The facts are read once, into counts by author, hours and state; authors and medians come from those.
    """
    work = work_items(fact_issues, fact_prs)
    parts = ["repo_id", "kind", "author_user_id", "hours"]
    seen = written(
        work.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("state") == "open").alias("n_open")),
        "work-counts",
    )
    # per author first: distinct authors become a plain count, and a huge repository is spread over its authors
    per_author = seen.groupBy(*parts[:3]).agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open"))
    medians = health_medians(value_counts(seen, "hours", ["repo_id", "kind"], weight="n"))
    return health_rows(dim_repositories, health_counts(per_author).join(medians, "repo_id", "left"))


def milestones(fact_issues: DataFrame, fact_prs: DataFrame) -> DataFrame:
    """One row per dated milestone (opened / closed / merged) of every issue and pull request."""

    def events(df: DataFrame, opened: str, done: str, done_key: str, hours: str) -> DataFrame:
        nothing = F.lit(None).cast(df.schema[hours].dataType)
        pair = F.array(
            F.struct(
                F.lit(opened).alias("kind"), F.col("created_date_key").alias("day_key"), nothing.alias("hours")
            ),
            F.struct(F.lit(done).alias("kind"), F.col(done_key).alias("day_key"), F.col(hours).alias("hours")),
        )
        return df.select("repo_id", F.inline(pair)).filter(F.col("day_key").isNotNull())

    return events(
        fact_issues, "issues_opened", "issues_closed", "closed_date_key", "time_to_close_hours"
    ).unionByName(events(fact_prs, "prs_opened", "prs_merged", "merged_date_key", "time_to_merge_hours"))


COUNTERS = ("issues_opened", "issues_closed", "prs_opened", "prs_merged")


def limits(bounds: DataFrame) -> Column:
    """The one-row calendar frame as one scalar subquery: a struct of both days and both day keys."""
    days = [F.col("start"), F.col("end"), date_key("start").alias("start_key"), date_key("end").alias("end_key")]
    return bounds.select(F.struct(*days).alias("limits")).scalar()


def kpi_time_series(
    fact_issues: DataFrame, fact_prs: DataFrame, dim_repositories: DataFrame, bounds: DataFrame
) -> DataFrame:
    """Monthly activity per current repository, with a row for every month of the calendar ``bounds``.

    The calendar has no gaps, so belonging to it is a range test on the date key, and the month comes from the
    key by arithmetic: the facts are never joined to a calendar table.
    """
    calendar = limits(bounds)
    dated = (
        milestones(fact_issues, fact_prs)
        .filter(F.col("day_key").between(calendar.getField("start_key"), calendar.getField("end_key")))
        .select("repo_id", month_of_key("day_key").alias("month_year"), "kind", "hours")
    )
    # one pass over the facts: counters are sums over these counts, and the medians look into them
    counts = dated.groupBy("repo_id", "month_year", "kind", "hours").agg(F.count(F.lit(1)).alias("n_rows"))
    measured = month_measures(written(counts, "milestones"))
    return series_rows(dim_repositories, measured, calendar.getField("start"), calendar.getField("end"))


def month_measures(counts: DataFrame) -> DataFrame:
    """Counters and medians per repository and month from rows (repo_id, month_year, kind, hours, n_rows)."""
    keys = ["repo_id", "month_year"]
    counters = counts.groupBy(*keys).agg(*[F.sum(_when(k, F.col("n_rows"))).alias(k) for k in COUNTERS])
    medians = _medians(
        counts.filter(F.col("kind").isin("issues_closed", "prs_merged")),
        keys,
        {"issues_closed": "median_time_to_close_hours", "prs_merged": "median_time_to_merge_hours"},
    )
    return counters.join(medians, keys, "left")


def series_rows(dim_repositories: DataFrame, measured: DataFrame, start: Column, end: Column) -> DataFrame:
    """The KPI's rows from measures per repository and month: every month of the calendar for every repository."""
    return (
        densify(current_repos(dim_repositories), start, end)
        .join(measured, ["repo_id", "month_year"], "left")
        .select(
            "repo_id",
            "repo_name",
            "month_year",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTERS[:2]],
            "median_time_to_close_hours",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTERS[2:]],
            "median_time_to_merge_hours",
        )
    )


CONTRIBUTIONS = (
    "total_issues_opened",
    "total_prs_opened",
    "total_prs_merged",
    "total_comments",
    "total_additions",
    "total_deletions",
)


def kpi_user_contributions(
    fact_issues: DataFrame,
    fact_prs: DataFrame,
    dim_repositories: DataFrame,
    dim_users: DataFrame,
    null_safe: bool = False,
) -> DataFrame:
    """Activity per repository and user.

    A pair with an unknown user or repository keeps its row but counts 0, as equality joins on null keys would
    give; ``null_safe`` reports its real counts instead.
    """
    sums = deeds(fact_issues, fact_prs).groupBy("repo_id", "user_id").agg(*[F.sum(c).alias(c) for c in CONTRIBUTIONS])
    return contribution_rows(sums, dim_repositories, dim_users, null_safe)


def deeds(fact_issues: DataFrame, fact_prs: DataFrame) -> DataFrame:
    """What each issue and pull request counts for its author."""
    who = F.col("author_user_id").alias("user_id")
    none = F.lit(0).cast("long")
    return fact_issues.select(
        "repo_id", who, F.lit(1).alias("total_issues_opened"), none.alias("total_prs_opened"),
        none.alias("total_prs_merged"), F.col("comment_count").alias("total_comments"),
        none.alias("total_additions"), none.alias("total_deletions"),
    ).unionByName(
        fact_prs.select(
            "repo_id", who, none.alias("total_issues_opened"), F.lit(1).alias("total_prs_opened"),
            F.col("merged_date_key").isNotNull().cast("long").alias("total_prs_merged"),
            F.col("comment_count").alias("total_comments"),
            F.col("additions").alias("total_additions"), F.col("deletions").alias("total_deletions"),
        )
    )


def contribution_rows(sums: DataFrame, dim_repositories: DataFrame, dim_users: DataFrame, null_safe: bool = False) -> DataFrame:
    """The KPI's rows from sums per repository and user."""
    keys = ["repo_id", "user_id"]
    known = F.lit(True) if null_safe else F.col("repo_id").isNotNull() & F.col("user_id").isNotNull()
    amounts = [F.when(known, F.coalesce(c, F.lit(0))).otherwise(F.lit(0)).alias(c) for c in CONTRIBUTIONS]
    users = dim_users.select("user_id", F.col("user_login").alias("github_username"))
    return (
        sums.select(*keys, *amounts)
        .join(current_repos(dim_repositories), "repo_id", "left")
        .join(users, "user_id", "left")
        .select("repo_name", "repo_id", "user_id", "github_username", *CONTRIBUTIONS)
    )


# fixed values: first size (in changed lines) that no longer belongs to the bucket
SIZE_LIMITS = (("Small", 100), ("Medium", 500), ("Large", 1000))
SIZE_ORDER = ("Small", "Medium", "Large", "XL", "Unknown")


def size_bucket(lines: Column) -> Column:
    bucket = F.when(lines.isNull(), "Unknown")
    for name, limit in SIZE_LIMITS:
        bucket = bucket.when(lines < limit, name)
    return bucket.otherwise("XL")


def kpi_pr_complexity(fact_prs: DataFrame, dim_repositories: DataFrame) -> DataFrame:
    """Size, shape and merge time of every pull request. Missing details count as 0 changed lines."""
    lines = F.coalesce("additions", F.lit(0)) + F.coalesce("deletions", F.lit(0))
    sized = fact_prs.withColumn("total_lines_changed", lines)
    return sized.join(current_repos(dim_repositories), "repo_id", "left").select(
        "pr_id",
        "repo_name",
        "repo_id",
        "author_user_id",
        "created_date_key",
        "merged_date_key",
        "time_to_merge_hours",
        "additions",
        "deletions",
        "changed_files",
        "commits_count",
        "total_lines_changed",
        ratio("additions", "total_lines_changed").alias("additions_ratio"),
        ratio("deletions", "total_lines_changed").alias("deletions_ratio"),
        size_bucket(F.col("total_lines_changed")).alias("pr_size_bucket"),
    )
