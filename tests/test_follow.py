"""The daily run by changes: equal to full computations, and reading only what changed."""

import random

import landing
import pytest
from pyspark.sql import functions as F

from strata.operators.checks import check_not_null, check_relationship, check_unique
from strata.operators.quality import Rule
from strata.plans import daily, gold, rules, staging, validated
from strata.plans.check_state import Check, CheckState
from strata.plans.daily import Options, Warehouse, run_day
from strata.sources import bronze, tables
from strata.sources.changes import ChangeLog, upsert_logged
from strata.streaming.landing import add_versions


def run(spark, raw, w, day, hour=2, **kw):
    return run_day(spark, raw, w, day, f"{day} 0{hour}:00:00", **kw)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def stable(df):
    return sorted(map(repr, df.drop("_gold_update_ts").collect()))


@pytest.fixture
def followed(warehouse):
    return warehouse[0]


def test_deltas_equal_the_full_computation(followed, moment="2024-03-03 02:00:00"):
    """All KPIs and the calendar, computed anew from the whole facts."""
    w = followed
    kept = {n: stable(df.select(*sorted(df.columns))) for n in (*daily.KPIS, "dim_date") for df in [w.read(f"gold/{n}")]}
    full = Warehouse(w.spark, w.root, Options(buckets=3, full_kpis=True))
    daily.refresh_kpis(full, F.lit(moment).cast("timestamp"))
    for name, before in kept.items():
        df = full.read(f"gold/{name}")
        assert before and stable(df.select(*sorted(df.columns))) == before, name


def test_facts_equal_a_rebuild(followed):
    w = followed
    repos = w.read("gold/dim_repositories_current")
    for name, history, build in (
        ("fact_issues", "history/issues", gold.fact_issues),
        ("fact_pull_requests", "history/pull_requests", gold.fact_pull_requests),
    ):
        whole = build(w.read_open(history), repos, F.lit(None))
        assert stable(w.read(f"gold/{name}").select(*whole.columns)) == stable(whole)


def test_day_three_touches_only_its_rows(spark, followed):
    """What each step took on the last day: the backfilled issue and the closed pull request, from feed files alone."""
    w = followed
    for name, key, keys in (
        ("validated/issues", "issue_id", {109}),
        ("history/issues", "issue_id", {109}),
        ("gold/fact_issues", "issue_id", {109}),
        ("staged/pull_requests", "pull_request_id", {201}),
        ("staged/pr_details", "pull_request_id", set()),
        ("validated/pull_requests", "pull_request_id", {201}),
        ("history/pull_requests", "pull_request_id", {201}),
        ("gold/fact_pull_requests", "pr_id", {201}),
    ):
        log = ChangeLog(spark, w.path(name))
        feed = log.since(log.newest() - 1)
        assert (feed is None) == (not keys), name  # nothing came: only the marks were written
        if keys:
            assert {r[0] for r in feed.select(key).collect()} == keys, name
            assert all(f"/_changes/{log.newest():010d}/" in f for f in feed.inputFiles())


def test_counts_follow_the_changes(spark, followed):
    """The last day's deltas: issue 109 opened by a new author; pull request 201 no longer open. Repository 1 is not measured."""
    w = followed
    log = ChangeLog(spark, w.path("kpi_state/health"))
    assert {r[0] for r in log.since(log.newest() - 1).select("repo_id").collect()} == {2, 3}
    log = ChangeLog(spark, w.path("kpi_state/authors"))
    changed = log.since(log.newest() - 1).select("change", "repo_id", "kind", "author_user_id", "n", "n_open")
    assert set(map(tuple, changed.collect())) == {
        ("after", 3, "issue", 9, 1, 1), ("before", 2, "pr", 8, 1, 1), ("after", 2, "pr", 8, 1, 0),
    }


def test_marks_replace_a_look_at_the_target(followed):
    w = followed
    assert w.marks("validated/issues")["bronze"] == "2024-03-03 02:00:00"
    lines = w.fresh(w.bronze("issues"), "validated/issues")
    assert lines.count() == 0
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "validated" not in plan  # the bound is a literal


def test_a_repository_that_comes_after_its_records(spark, tmp_path):
    raw, w = str(tmp_path / "raw"), Warehouse(spark, str(tmp_path / "wh"), Options(buckets=3))
    one, two = landing.day_one(), landing.day_two()
    one["repositories"] = [r for r in one["repositories"] if r[1]["id"] != 2]
    landing.land(raw, landing.DAYS[0], one)
    run(spark, raw, w, landing.DAYS[0])
    assert rows(w.read_open("history/issues").filter("repository_id is null"), "issue_id") == [(107,)]
    assert {r[0] for r in w.read("pending/issues").select("issue_id").collect()} >= {103, 107}
    assert rows(w.read("gold/fact_pull_requests"), "pr_id", "repo_id") == [(200, 1), (201, None)]
    two["issues"], two["pr_details"] = [i for i in two["issues"] if i[1]["id"] == 100], []
    landing.land(raw, landing.DAYS[1], two)
    run(spark, raw, w, landing.DAYS[1])
    # the unchanged records of the second repository
    assert rows(w.read("history/issues").filter("issue_id = 107"), "repository_id", "valid_to") == [(2, None)]
    assert rows(w.read("gold/fact_pull_requests"), "pr_id", "repo_id") == [(200, 1), (201, 2)]
    assert w.read("pending/issues") is None and w.read("pending/pull_requests") is None  # nothing waits any more
    health = dict(rows(w.read("gold/kpi_repo_health"), "repo_id", "total_issues"))
    assert health[2] == 1
    log = ChangeLog(spark, w.path("history/issues"))
    feed = log.since(log.newest() - 1)
    assert rows(feed, "issue_id", "change") == [(100, "closed"), (100, "opened"), (107, "refreshed")]


def test_a_loosened_rule_frees_its_rows(spark, tmp_path, monkeypatch):
    """Rows without a change of their own: quarantined by a rule, freed by its absence, held back again by another one."""
    w, key = Warehouse(spark, str(tmp_path / "wh"), Options(buckets=2)), "issue_id"
    landing.land(str(tmp_path / "raw"), landing.DAYS[0], {"issues": landing.day_one()["issues"]})
    lines = bronze.parse_bronze(bronze.scan_raw(spark, str(tmp_path / "raw")), F.lit("2024-03-01 02:00:00").cast("timestamp"), "2024-03-01")
    repos = spark.createDataFrame([(1, "octo", "alpha"), (2, "octo", "beta")], "repository_id long, owner_login string, repo_name string")
    dims = spark.createDataFrame([(1, "s1"), (2, "s2")], "repo_id long, repository_sk string")
    judged = validated.validate_issues(staging.stage_issues(lines), repos)

    def follow():
        daily.snapshot(w, "validated/issues", "history/issues", key, ["repository_id"])
        daily.refresh_facts(w, dims, F.lit(None).cast("timestamp"))

    w.upsert("validated/issues", judged, key, marks=daily.judged_again(w, "issues", rules.ISSUE_RULES, key))
    follow()
    before = {r[0] for r in w.read("gold/fact_issues").select(key).collect()}
    looser = [r for r in rules.ISSUE_RULES if r.name != "comments_count_non_negative"]
    daily.judged_again(w, "issues", looser, key)
    follow()
    assert {r[0] for r in w.read("gold/fact_issues").select(key).collect()} == before | {104}
    log = ChangeLog(spark, w.path("validated/issues"))
    assert {r[0] for r in log.since(1).select(key).collect()} == {104}
    daily.judged_again(w, "issues", looser, key)  # the same rules: nothing is looked at
    assert log.newest() == 2
    daily.judged_again(w, "issues", [*looser, Rule("not_the_first", "issue_id <> 100")], key)
    assert rows(w.read("validated/issues").filter("is_quarantined"), key)[0] == (100,)


def test_violations_by_deltas_equal_full_checks(spark, tmp_path):
    """Random rows that come, change and go, against the checks over the whole tables."""
    rnd, root = random.Random(4), str(tmp_path)
    paths = {n: f"{root}/{n}" for n in ("child", "parent")}
    checks = (
        Check("not_null", "child", ("fk",)),
        Check("unique", "child", ("fk", "v")),
        Check("relationships", "child", ("fk",), "parent", ("k",)),
    )
    state = CheckState(spark, f"{root}/state", paths, checks, buckets=2)
    assert {r.violations for r in state.violations().collect()} == {0}
    for _ in range(3):
        child = [(k, rnd.choice([None, *range(6)]), rnd.randint(0, 2)) for k in rnd.sample(range(20), 9)]
        parent = [(k,) for k in rnd.sample(range(6), 2)]
        upsert_logged(spark, paths["child"], spark.createDataFrame(child, "id int, fk int, v int"), ["id"], F.col("id") % 2)
        upsert_logged(spark, paths["parent"], spark.createDataFrame(parent, "k int"), ["k"], F.lit(0))
        state.refresh()
        rows_, keys = (tables.read_table(spark, paths[n]) for n in ("child", "parent"))
        assert {r.check: r.violations for r in state.violations().collect()} == {
            "not_null child fk": check_not_null(rows_, "fk").count(),
            "unique child fk,v": check_unique(rows_, ["fk", "v"]).count(),
            "relationships child fk": check_relationship(rows_, "fk", keys, "k").count(),
        }
    state.refresh()  # nothing new
    assert {r.check for r in state.violations().collect()} == {c.name for c in checks}


def test_a_stopped_day_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    """A run that dies between history and facts, then the day again: nothing is missing and nothing counts twice."""
    raw, w = str(tmp_path / "raw"), Warehouse(spark, str(tmp_path / "wh"), Options(buckets=2, keep_changes=0))
    for day, content in zip(landing.DAYS[:2], (landing.day_one(), landing.day_two()), strict=True):
        landing.land(raw, day, content)
    run(spark, raw, w, landing.DAYS[0])
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(daily, "refresh_facts", lambda *_: (_ for _ in ()).throw(RuntimeError()))
        run(spark, raw, w, landing.DAYS[1])
    run(spark, raw, w, landing.DAYS[1], hour=4)
    versions = rows(w.read("history/issues").filter("issue_id = 100"), "state", "valid_to")
    assert [v[0] for v in versions] == ["closed", "open"] and [v[1] is None for v in versions] == [True, False]
    test_facts_equal_a_rebuild(w)
    test_deltas_equal_the_full_computation(w, "2024-03-02 04:00:00")
    assert ChangeLog(spark, w.path("history/issues")).since(0) is None  # its reader has taken everything


def test_repeated_micro_batches_neither_double_nor_lose_versions(spark, tmp_path):
    path, bucket = str(tmp_path / "h"), F.col("k") % 2
    batches = [[(1, 1), (1, 3), (2, 2)], [(1, 4), (3, 1), (3, 2), (2, 1)], [(2, 5)]]

    def feed(number):
        df = spark.createDataFrame(batches[number], "k int, at int")
        add_versions(spark, path, df, ["k"], "at", bucket, number)

    for number in (0, 1, 1, 0, 2):
        feed(number)
    got = rows(tables.read_table(spark, path), "k", "valid_from", "valid_to")
    # a change older than the open version opens none
    assert got == [(1, 1, 3), (1, 3, 4), (1, 4, None), (2, 2, 5), (2, 5, None), (3, 1, 2), (3, 2, None)]
    assert ChangeLog(spark, path).marks() == {"batch": 2}
