"""Every registered query beside its SQL on DuckDB."""

import __spark_entry__ as entry_points
import pytest

from verification import compare
from verification.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.fixture(scope="module")
def sf_dir():
    import os

    return os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare.compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 25


ORDERED = {  # report: columns that must rise, or fall where marked
    "dash_repo_list": [("repo_name", 1)],
    "dash_repo_health": [("repo_name", 1)],
    "dash_time_series": [("month_year", 1)],
    "dash_user_contributions": [("total_prs_merged", -1, "total_issues_opened")],
    "dash_pr_complexity": [("total_lines_changed", -1)],
    "dash_repo_workload": [("approximate_total_contributors", 1)],
    "dash_leaderboard": [("PRs Merged", -1, "Issues")],
    "dash_top_merged": [("total_prs_merged", -1)],
    "dash_top_additions": [("total_additions", -1)],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_reports_keep_their_order(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    for column, direction, *more in ORDERED[name]:
        values = [r[column] + sum(r[c] for c in more) if more else r[column] for r in rows]
        assert len(values) > 1 and values == sorted(values, reverse=direction < 0)


def test_increments_are_not_empty(spark, sf_dir):
    assert QUERIES["hwm_filter"](spark, sf_dir).count() > 0


def test_kept_views_are_computed_once(spark, sf_dir):
    """What the export's tables are made of is written once: none of them goes back to the lines."""
    from verification.analogues import Kept
    from verification.model_queries import Star

    star = Star(Kept(spark, sf_dir))
    for df in (star.prs, star.users, star.build_fact_prs(), star.build_fact_issues()):
        assert not [f for f in df.inputFiles() if "lineitem" in f or "events" in f]
