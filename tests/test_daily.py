"""The whole run over three landed days."""

import landing
import pytest
from pyspark.sql import functions as F

from strata.operators.incremental import lookback_filter
from strata.plans import contracts, daily, gold, staging, validated
from strata.plans.daily import Options, Warehouse, run_day


def run(spark, raw, w, day, hour=2, **kw):
    return run_day(spark, raw, w, day, f"{day} 0{hour}:00:00", **kw)


def rows(df, *cols, order=None):
    return [tuple(r) for r in df.select(*cols).orderBy(*(order or cols)).collect()]


def stable(w, name, *drop):
    df = w.read(name)
    return sorted(map(repr, df.drop("_gold_update_ts", "_bronze_ingest_ts", "scd_id", *drop).collect()))


def test_load_summary_skips_missing_resources(warehouse):
    _, seen, _ = warehouse
    first = {r.resource: (r.n_rows, r.status) for r in seen["2024-03-01"]}
    second = {r.resource: (r.n_rows, r.status) for r in seen["2024-03-02"]}
    assert first["issues"] == (12, "OK") and first["repositories"] == (3, "OK")
    assert second["releases"] == (0, "SKIPPED") and second["pull_requests"] == (0, "SKIPPED")


def test_newest_copy_wins_across_days(warehouse):
    w, *_ = warehouse
    got = dict(rows(w.read("validated/issues").filter("issue_id in (100, 101)"), "issue_id", "state"))
    assert got == {100: "closed", 101: "closed"}


def test_bad_rows_are_quarantined_with_reasons(warehouse):
    w, *_ = warehouse
    bad = {r[0]: r[1] for r in rows(w.read("validated/issues").filter("is_quarantined"), "issue_id", "dq_failed_rules")}
    assert bad == {
        103: ["closed_at_after_created"],
        104: ["comments_count_non_negative"],
        105: ["issue_number_positive"],
        106: ["created_at_not_null", "created_before_updated"],
        107: ["comments_count_non_negative"],
    }
    prs = rows(w.read("validated/pull_requests").filter("is_quarantined"), "pull_request_id", "dq_failed_rules")
    assert prs == [(202, ["merged_implies_closed"])]
    languages = rows(w.read("silver/languages"), "language", "bytes", "is_quarantined")
    assert languages == [("Python", 7, False)]


def test_unparsable_lines_are_all_kept(warehouse):
    w, *_ = warehouse
    view = daily.silver_views(w)["issues_current"]
    lone = view.filter("issue_id is null")
    assert lone.count() == 2 and lone.filter("is_quarantined").count() == 2


def test_clean_then_bad_shows_from_both_sides(warehouse):
    w, *_ = warehouse
    view = daily.silver_views(w)["issues_current"].filter("issue_id = 107")
    assert rows(view, "record_source") == [("history",), ("quarantine",)]
    assert daily.silver_views(w)["issues_current"].filter("issue_id = 102").count() == 0


def test_issue_history_closes_at_the_new_update(warehouse):
    w, *_ = warehouse
    got = rows(w.read("history/issues").filter("issue_id = 100"), "state", F.col("valid_to").isNull(), order=["valid_from"])
    assert got == [("open", False), ("closed", True)]
    ends = w.read("history/issues").filter("issue_id = 100 and valid_to is not null").select("valid_to").first()[0]
    assert str(ends) == "2024-03-01 12:00:00"


def test_repository_history_follows_business_columns_only(warehouse):
    w, *_ = warehouse
    n = dict(rows(w.read("history/repositories").groupBy("repository_id").count(), "repository_id", "count"))
    # 1: stars moved; 2: description null -> text; 3: only pushed_at moved
    assert n == {1: 2, 2: 2, 3: 1}


def test_late_details_reach_an_unchanged_pull_request(warehouse):
    w, seen, _ = warehouse
    # on day two only the details came
    assert seen["after day two"] == {
        "facts": {200: 90, 201: 700}, "sizes": {200: "Medium", 201: "Large"}, "versions": {200: 1, 201: 1},
    }
    got = {r[0]: r[1] for r in rows(w.read("gold/fact_pull_requests"), "pr_id", "additions")}
    assert got == {200: 90, 201: 700}
    sizes = dict(rows(w.read("gold/kpi_pr_complexity"), "pr_id", "pr_size_bucket"))
    assert sizes == {200: "Medium", 201: "Large"}


def test_pull_requests_older_than_the_first_issue_stay_in_the_series(warehouse):
    w, *_ = warehouse
    s = w.read("gold/kpi_time_series")
    opened = rows(s.filter("prs_opened > 0"), "repo_name", "month_year", "prs_opened")
    assert opened == [("octo/alpha", "2023-06", 1), ("octo/beta", "2024-01", 1)]
    # dense: every repository has every month
    assert s.count() == 3 * s.select("month_year").distinct().count()


def test_users_take_their_newest_login(warehouse):
    w, *_ = warehouse
    assert dict(rows(w.read("gold/dim_users"), "user_id", "user_login"))[7] == "ada2"


def test_backfilled_issues_of_a_followed_repository_reach_the_facts(warehouse):
    w, *_ = warehouse
    assert w.read("gold/fact_issues").filter("issue_id = 109").count() == 1


def test_legacy_lookback_leaves_a_backfill_out_unless_counted_per_repository(warehouse):
    w, *_ = warehouse
    stored = w.read("gold/fact_issues").filter("issue_id <> 109")
    fact = gold.fact_issues(w.read_open("history/issues"), w.read("gold/dim_repositories_current"), F.lit(None))
    assert lookback_filter(fact, stored, "updated_at", 3).filter("issue_id = 109").count() == 0
    per_repo = lookback_filter(fact, stored.filter("repo_id <> 3"), "updated_at", 3, scope="repo_id")
    assert per_repo.filter("issue_id = 109").count() == 1


def test_broken_release_and_detail_lines_are_kept(warehouse):
    w, *_ = warehouse
    lone = daily.silver_views(w)["releases"].filter("release_id is null")
    assert rows(lone, "is_quarantined", "_ingestion_date") == [(True, "2024-03-01")]
    assert daily.tables.read_or_none(w.spark, w.path("unkeyed/pr_details")).count() == 1


def test_an_early_moment_is_refused_before_anything_is_written(spark, warehouse):
    w, _, root = warehouse
    before = w.bronze("issues").count()
    with pytest.raises(ValueError, match="later"):
        run(spark, f"{root}/raw", w, landing.DAYS[0])
    assert w.bronze("issues").count() == before


def test_increments_read_only_the_dates_loaded_since(warehouse):
    w, *_ = warehouse
    assert w.fresh(w.bronze("issues"), "validated/issues").count() == 0
    # as seen from a table that took its last rows on day one
    lines = w.fresh(w.bronze("issues"), "silver/releases")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_ingestion_date" in plan
    assert rows(lines.select("_ingestion_date").distinct(), "_ingestion_date") == [(d,) for d in landing.DAYS[1:]]


def test_watermarks_and_export(spark, warehouse):
    w, _, root = warehouse
    assert rows(w.read("watermarks"), "repo", "boundary") == [("octo/alpha", "2024-03-03T00:00:00Z")]
    assert spark.read.parquet(f"{root}/export/kpi_repo_health").count() == 3


def test_contracts(warehouse):
    """All 83 checks, over every table and view of the run."""
    w, *_ = warehouse
    repos = w.read("staged/repositories")
    releases, languages = staging.stage_releases(w.bronze("releases")), staging.stage_languages(w.bronze("languages"))
    views = {
        "staged/issues": staging.stage_issues(w.bronze("issues")),
        "staged/releases": releases,
        "staged/languages": languages,
        "validated/releases": validated.validate_releases(releases, repos),
        "validated/languages": validated.validate_languages(languages, repos),
        **daily.silver_views(w),
    }
    stored = {n for n in (*contracts.NOT_NULL, *contracts.ONE_CURRENT) if n not in views}
    found = contracts.violations({**{n: w.read(n) for n in stored}, **views}).collect()
    assert len(found) == 83
    # the landed days hold three unparsable lines and an issue without an author
    assert {(r.check, r.table, r.columns): r.violations for r in found if r.violations} == {
        ("not_null", "staged/issues", "issue_id"): 2,
        ("not_null", "staged/issues", "updated_at"): 2,
        ("not_null", "issues_current", "issue_id"): 2,
        ("not_null", "issues_current", "repository_url"): 2,
        ("not_null", "staged/releases", "release_id"): 1,
        ("not_null", "validated/releases", "release_id"): 1,
        ("not_null", "releases", "release_id"): 1,
        ("not_null", "releases", "tag_name"): 1,
        ("not_null", "gold/fact_issues", "author_user_sk"): 1,
        ("not_null", "gold/kpi_user_contributions", "user_id"): 1,
    }


def test_rerun_of_a_day_changes_nothing(spark, warehouse, tmp_path):
    _, _, root = warehouse
    w = Warehouse(spark, str(tmp_path / "wh"), Options(buckets=2, id_width=100))
    for day in landing.DAYS[:2]:
        run(spark, f"{root}/raw", w, day)
    names = ["validated/issues", "validated/pull_requests", "history/issues", "history/pull_requests",
             "history/repositories", "gold/fact_issues", "gold/fact_pull_requests", *[f"gold/{k}" for k in daily.KPIS]]
    before = {n: stable(w, n) for n in names}
    run(spark, f"{root}/raw", w, landing.DAYS[1], hour=5)
    for n in names:
        assert stable(w, n) == before[n], n
    assert daily.silver_views(w)["issues_current"].filter("issue_id is null").count() == 2
