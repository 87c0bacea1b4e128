"""Report queries over the KPI tables, and the export they read from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans import reports
from strata.session import scratch_dir
from strata.sources import tables
from verification.analogues import A_RELEASES, STAR, Kept, Tables
from verification.model_queries import (
    COMPLEXITY,
    CONTRIBUTIONS,
    HEALTH,
    HEALTH_MEDIANS,
    SERIES,
    USERS,
    Star,
    rounded,
)
from verification.registry import query

H = f"with {STAR},{HEALTH}"
S = f"with {STAR},{SERIES}"
P = f"with {STAR},{COMPLEXITY}"
U = f"with {STAR},{A_RELEASES},{USERS},{CONTRIBUTIONS}"
ACTIVE = "(issues_opened > 0 or issues_closed > 0 or prs_opened > 0 or prs_merged > 0)"
REPO = "ASIA/NATION_2"


EXPORTED = f"""
with {STAR},{A_RELEASES},{USERS},{HEALTH},{SERIES},{CONTRIBUTIONS},{COMPLEXITY}
select 'kpi_repo_health' as name, repo_id, null as part, total_issues as a, total_prs as b, median_time_to_close_hours as c
from health
union all select 'kpi_time_series', repo_id, month_year, issues_opened, prs_opened, median_time_to_merge_hours from series
union all select 'kpi_user_contributions', repo_id, github_username, total_comments, total_additions, null from users
union all select 'kpi_pr_complexity', repo_id, pr_size_bucket, pr_id, total_lines_changed, time_to_merge_hours from prs"""


@query(EXPORTED)
def kpi_export_roundtrip(t: Tables) -> DataFrame:
    """All four tables written and read back."""
    star, path, none = Star(Kept(t.spark, t.dir)), scratch_dir(t.spark, "export"), F.lit(None)
    exported = {
        "kpi_repo_health": (star.health, none, "total_issues", "total_prs", HEALTH_MEDIANS[0]),
        "kpi_time_series": (star.series, "month_year", "issues_opened", "prs_opened", HEALTH_MEDIANS[1]),
        "kpi_user_contributions": (star.users, "github_username", "total_comments", "total_additions", none),
        "kpi_pr_complexity": (star.prs, "pr_size_bucket", "pr_id", "total_lines_changed", "time_to_merge_hours"),
    }
    tables.export_tables({name: found[0] for name, found in exported.items()}, path)
    out = None
    for name, (_, part, x, y, z) in exported.items():
        z = none if z is none else F.round(F.col(z).cast("double"), 6)
        part = part if part is none else F.col(part)
        rows = tables.read_export(t.spark, path, name).select(
            F.lit(name).alias("name"), "repo_id", part.cast("string").alias("part"), F.col(x).cast("bigint").alias("a"),
            F.col(y).cast("bigint").alias("b"), z.cast("double").alias("c"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(f"{H} select * from health")
def dash_repo_health(t: Tables) -> DataFrame:
    return rounded(reports.repo_health(Star(t).health), *HEALTH_MEDIANS)


@query(f"{S} select * from series where repo_name = '{REPO}'")
def dash_time_series(t: Tables) -> DataFrame:
    return rounded(reports.time_series(Star(t).series, REPO), *HEALTH_MEDIANS)


@query(f"{P} select * from prs where repo_name = '{REPO}'")
def dash_pr_complexity(t: Tables) -> DataFrame:
    return rounded(reports.pr_complexity(Star(t).prs, REPO), "time_to_merge_hours")


@query(f"{U} select * from users where repo_name = '{REPO}'")
def dash_user_contributions(t: Tables) -> DataFrame:
    return reports.user_contributions(Star(t).users, REPO)


@query(f"{H} select distinct repo_name from health")
def dash_repo_list(t: Tables) -> DataFrame:
    return reports.repo_list(Star(t).health)


@query(f"""{H} select cast(sum(total_issues) as bigint) as total_issues, cast(sum(open_issues) as bigint) as open_issues,
  cast(sum(total_prs) as bigint) as total_prs, cast(sum(open_prs) as bigint) as open_prs,
  round(avg(median_time_to_close_hours), 6) as avg_median_close_hours,
  round(avg(median_time_to_merge_hours), 6) as avg_median_merge_hours,
  cast(sum(approximate_total_contributors) as bigint) as community_members, count(*) as repositories from health""")
def dash_portfolio(t: Tables) -> DataFrame:
    return rounded(reports.portfolio(Star(t).health), "avg_median_close_hours", "avg_median_merge_hours")


@query(f"""{H} select string_split(repo_name, '/')[-1] as short_name, total_issues - open_issues as closed_issues,
  open_issues, total_prs - open_prs as closed_prs, open_prs, approximate_total_contributors from health""")
def dash_repo_workload(t: Tables) -> DataFrame:
    return reports.repo_workload(Star(t).health)


@query(f"{S} select * from series where {ACTIVE}")
def dash_active_months(t: Tables) -> DataFrame:
    return rounded(reports.active_months(Star(t).series), *HEALTH_MEDIANS)


@query(f"""{S} select month_year, cast(sum(issues_opened) as bigint) as issues_opened,
  cast(sum(issues_closed) as bigint) as issues_closed, cast(sum(prs_opened) as bigint) as prs_opened,
  cast(sum(prs_merged) as bigint) as prs_merged,
  round(avg(median_time_to_close_hours), 4) as median_time_to_close_hours,
  round(avg(median_time_to_merge_hours), 4) as median_time_to_merge_hours
  from series where {ACTIVE} group by month_year""")
def dash_monthly_rollup(t: Tables) -> DataFrame:
    rollup = reports.monthly_rollup(Star(t).series)
    return rollup.withColumns({c: F.round(c, 4) for c in HEALTH_MEDIANS})


@query(f"""{S} select cast(sum(issues_opened) as bigint) as issues_opened,
  cast(sum(issues_closed) as bigint) as issues_closed, cast(sum(prs_opened) as bigint) as prs_opened,
  cast(sum(prs_merged) as bigint) as prs_merged from series where {ACTIVE}""")
def dash_trend_totals(t: Tables) -> DataFrame:
    return reports.trend_totals(Star(t).series)


@query(f"""{S} select month_year, string_split(repo_name, '/')[-1] as short_name, issues_opened from series
  where {ACTIVE} and (select count(distinct repo_name) > 1 from series where {ACTIVE})""")
def dash_issues_by_repo(t: Tables) -> DataFrame:
    return reports.issues_by_repo(Star(t).series)


@query(f"""{P} select count(*) as total_prs, count(merged_date_key) as merged_prs,
  round(avg(total_lines_changed), 6) as avg_lines_changed,
  round(median(time_to_merge_hours) filter (where merged_date_key is not null), 6) as median_merge_hours from prs""")
def dash_pr_summary(t: Tables) -> DataFrame:
    return rounded(reports.pr_summary(Star(t).stored_prs), "avg_lines_changed", "median_merge_hours")


@query(f"""{P}, c as (select unnest(['Small', 'Medium', 'Large', 'XL', 'Unknown']) as pr_size_bucket,
    unnest([0, 1, 2, 3, 4]) as position),
  n as (select pr_size_bucket as b, count(*) as n from prs group by 1)
  select position, pr_size_bucket, coalesce(n, 0) as n_prs from c left join n on b = pr_size_bucket""")
def dash_size_distribution(t: Tables) -> DataFrame:
    return reports.size_distribution(Star(t).prs)


@query(f"""{P}, m as (select * from prs where merged_date_key is not null)
  select pr_id, total_lines_changed, time_to_merge_hours, pr_size_bucket, changed_files, commits_count from m
  where time_to_merge_hours <= (select quantile_cont(time_to_merge_hours, 0.99) from m)""")
def quantile_trim(t: Tables) -> DataFrame:
    return rounded(reports.lines_vs_merge_time(Star(t).stored_prs), "time_to_merge_hours")


@query(f"""{P}, m as (select changed_files as x from prs
    where changed_files <= (select quantile_cont(changed_files, 0.95) from prs)),
  w as (select min(x) as lo, (max(x) - min(x)) / 40 as step from m)
  select cast(least(floor((x - lo) / step), 39) as int) as bin, count(*) as n_rows,
         round(lo + least(floor((x - lo) / step), 39) * step, 6) as bin_from,
         round(lo + (least(floor((x - lo) / step), 39) + 1) * step, 6) as bin_to from m, w group by all""")
def dash_files_histogram(t: Tables) -> DataFrame:
    return rounded(reports.files_histogram(Star(t).prs), "bin_from", "bin_to")


@query(f"""{U} select count(distinct user_id) as unique_members, cast(sum(total_prs_merged) as bigint) as prs_merged,
  cast(sum(total_issues_opened) as bigint) as issues_opened, cast(sum(total_comments) as bigint) as total_comments
  from users""")
def dash_community_totals(t: Tables) -> DataFrame:
    return reports.community_totals(Star(t).users)


@query(f"""{U} select github_username as "User", string_split(repo_name, '/')[-1] as "Repository",
  total_prs_merged as "PRs Merged", total_issues_opened as "Issues", total_comments as "Comments",
  total_additions as "Lines Added", total_deletions as "Lines Deleted" from users
  order by total_prs_merged + total_issues_opened desc, repo_id, user_id limit 10""")
def dash_leaderboard(t: Tables) -> DataFrame:
    return reports.leaderboard(Star(t).users)


@query(f"""{U} select github_username || ' · ' || string_split(repo_name, '/')[-1] as label, total_prs_merged from users
  order by total_prs_merged desc, repo_id, user_id limit 10""")
def dash_top_merged(t: Tables) -> DataFrame:
    return reports.top_merged(Star(t).users)


@query(f"""{U} select github_username || ' · ' || string_split(repo_name, '/')[-1] as label, total_additions from users
  order by total_additions desc, repo_id, user_id limit 10""")
def dash_top_additions(t: Tables) -> DataFrame:
    return reports.top_additions(Star(t).users)
