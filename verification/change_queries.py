"""Tables that follow changes: feeds, late references, KPIs by deltas, stored deletes, versions, streams into history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import FAILED, FLAG, Rule, evaluate_rules, rules_digest
from strata.operators.quantiles import rank_index, value_counts
from strata.operators.ranking import numbered
from strata.plans import daily, gold, kpis, reports, rules, staging, validated
from strata.plans.check_state import Check, CheckState
from strata.plans.daily import Options, Warehouse
from strata.session import scratch_dir, written
from strata.sources import bronze, changes, tables, versions
from strata.streaming.landing import add_versions
from verification.analogues import A_ISSUES, A_RELEASES, A_REPOS, ISSUE_CHECKS, STAR, Kept, Tables, failing
from verification.model_queries import CONTRIBUTIONS, HEALTH, HEALTH_MEDIANS, SERIES, USERS, Star, as_of, rounded
from verification.registry import query
from verification.report_queries import REPO

LATE = 5  # repositories whose number leaves LATE - 1 come a day after their records


class Days:
    """Two days of the warehouse: records that open on the first, change or appear on the second, when the last repositories
    come as well."""

    def __init__(self, t: Tables, prs: bool = True, facts: bool = True, kpi_state: bool = False):
        self.t = t = Kept(t.spark, t.dir)
        self.star = Star(t)
        self.w = Warehouse(t.spark, scratch_dir(t.spark, "days"), Options(buckets=2))
        self.waiting: list[DataFrame] = []
        self.facts = facts
        repos = t.a_repos()
        early = repos.filter(F.col("repository_id") % LATE != LATE - 1)
        issues = t.a_issues().drop("true_repository_id")
        for day in (1, 2):
            known = early if day == 1 else repos
            self._load("issues", "issue_id", self._batch(issues, "issue_id", day, ["closed_at"], self._clean_issues), known)
            if prs:
                done = ["closed_at", "merged_at", *staging.DETAIL_MEASURES]
                batch = self._batch(t.a_prs(), "pull_request_id", day, done, self._clean_prs)
                self._load("pull_requests", "pull_request_id", batch, known)
            if facts:
                daily.refresh_facts(self.w, self.star.repos_current, as_of())
            if kpi_state:
                self.w.kpi_state().refresh()

    def _clean_issues(self, df: DataFrame) -> DataFrame:
        return validated.judge_issues(df, self.t.a_repos()).filter(~F.col(FLAG)).select(*df.columns)

    def _clean_prs(self, df: DataFrame) -> DataFrame:
        return validated.validate_pull_requests(df, self.t.a_repos()).filter(~F.col(FLAG)).select(*df.columns)

    def _batch(self, final: DataFrame, key: str, day: int, later: list[str], clean) -> DataFrame:
        """Day one: of keys 1 and 2 modulo 3 what will change, as it was opened, and of 1 what never changes."""
        changes = F.col("updated_at") > F.col("created_at")
        if day > 1:
            return final
        opened = clean(final.filter(changes & (F.col(key) % 3 != 0)))
        opened = opened.withColumns({c: F.lit(None).cast(final.schema[c].dataType) for c in later})
        opened = opened.withColumns({"state": F.lit("open"), "updated_at": F.col("created_at"), "_bronze_ingest_ts": F.col("created_at")})
        return opened.unionByName(final.filter(~changes & (F.col(key) % 3 == 1)))

    def _load(self, name: str, key: str, batch: DataFrame, repos: DataFrame) -> None:
        judge = daily.REFERENCES[name][2]
        rows = daily.with_late(self.w, name, judge(batch, repos), repos, key)
        self.w.upsert(f"validated/{name}", rows, key, ["updated_at", "_bronze_ingest_ts"])
        daily.keep_waiting(self.w, name, key, {"issues": "repository_url"}.get(name, "canonical_repo_name"))
        if name == "pull_requests" or self.facts:
            measures = [] if name == "issues" else staging.DETAIL_MEASURES
            daily.snapshot(self.w, f"validated/{name}", f"history/{name}", key, ["repository_id", *measures])
        if name == "issues":
            left = self.w.read("pending/issues")  # None when nothing waits any more
            left = batch.limit(0) if left is None else left
            self.waiting.append(written(left.select("issue_id"), "waiting"))


@query(f"""with {STAR}
select 'issue' as kind, issue_id as id, repo_id, repository_sk, author_user_id, created_date_key, closed_date_key, state,
       time_to_close_hours as hours, comment_count, updated_at from fact_issues
union all
select 'pr', pr_id, repo_id, repository_sk, author_user_id, created_date_key, merged_date_key, state, time_to_merge_hours,
       comment_count, updated_at from fact_prs""")
def fact_from_changes(t: Tables) -> DataFrame:
    """Both facts after two days of change feeds: as if built from scratch."""
    days = Days(t)
    issues = days.w.read("gold/fact_issues").select(
        F.lit("issue").alias("kind"), F.col("issue_id").alias("id"), "repo_id", "repository_sk", "author_user_id",
        "created_date_key", "closed_date_key", "state", F.col("time_to_close_hours").alias("hours"), "comment_count", "updated_at",
    )
    prs = days.w.read("gold/fact_pull_requests").select(
        F.lit("pr").alias("kind"), F.col("pr_id").alias("id"), "repo_id", "repository_sk", "author_user_id",
        "created_date_key", F.col("merged_date_key").alias("closed_date_key"), "state",
        F.col("time_to_merge_hours").alias("hours"), F.col("comment_count").cast("bigint").alias("comment_count"), "updated_at",
    )
    both = issues.withColumn("comment_count", F.col("comment_count").cast("bigint")).unionByName(prs)
    return rounded(both, "hours")


@query(f"""with {STAR},{HEALTH},{SERIES},{A_RELEASES},{USERS},{CONTRIBUTIONS}
select 'health' as kpi, repo_id, repo_name as part, total_issues as a, total_prs as b, open_issues as c,
       approximate_total_contributors as d, median_time_to_close_hours as x, median_time_to_merge_hours as y from health
union all select 'series', repo_id, month_year, issues_opened, prs_opened, issues_closed, prs_merged,
       median_time_to_close_hours, median_time_to_merge_hours from series
union all select 'users', repo_id, cast(user_id as varchar), total_issues_opened, total_prs_merged, total_comments,
       total_additions, null, null from users""")
def kpi_from_deltas(t: Tables) -> DataFrame:
    """KPIs kept by signed deltas over two days: as if computed from whole facts."""
    days = Days(t, kpi_state=True)
    state, repos = days.w.kpi_state(), days.star.dim_repositories
    bounds = gold.calendar_bounds(days.w.read("gold/fact_issues"), days.w.read("gold/fact_pull_requests"))
    found = {
        "health": (state.repo_health(repos), "repo_name", "total_issues", "total_prs", "open_issues", "approximate_total_contributors"),
        "series": (state.time_series(repos, bounds), "month_year", *[kpis.COUNTERS[k] for k in (0, 2, 1, 3)]),
        "users": (
            state.user_contributions(repos, days.star.dim_users), "user_id",
            "total_issues_opened", "total_prs_merged", "total_comments", "total_additions",
        ),
    }
    out = None
    for name, (df, part, *counts) in found.items():
        medians = [F.lit(None)] * 2 if name == "users" else [F.round(F.col(m).cast("double"), 6) for m in HEALTH_MEDIANS]
        rows = df.select(
            F.lit(name).alias("kpi"), "repo_id", F.col(part).cast("string").alias("part"),
            *[F.col(c).cast("bigint").alias(n) for c, n in zip(counts, "abcd", strict=True)],
            *[m.cast("double").alias(n) for m, n in zip(medians, "xy", strict=True)],
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(f"""with {A_REPOS},{A_ISSUES}
select 1 as day, issue_id from a_issues
where repository_id % {LATE} = {LATE - 1}
  and (updated_at > created_at and issue_id % 3 <> 0 and comments_count >= 0 and issue_number > 0
       or updated_at <= created_at and issue_id % 3 = 1)""")
def late_references(t: Tables) -> DataFrame:
    """Issues that wait for their repository at the end of each day: none from the second day on."""
    days = Days(t, prs=False, facts=False)
    return _stacked([df.select(F.lit(k + 1).alias("day"), "issue_id") for k, df in enumerate(days.waiting)])


def _stacked(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


@query("""
select 'type' as what, event_type as part, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95,
       round(quantile_cont(value, 0.99), 6) as p99 from events group by event_type
union all
select 'segment', c_mktsegment, round(quantile_cont(c_acctbal, 0.5), 6), round(quantile_cont(c_acctbal, 0.95), 6),
       round(quantile_cont(c_acctbal, 0.99), 6) from customer where c_mktsegment in ('BUILDING', 'MACHINERY') group by c_mktsegment""")
def quantiles_from_index(t: Tables) -> DataFrame:
    """Three quantiles of every group from one index; once with windows, once with ordered parts and only some groups."""
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    events = rank_index(value_counts(t.events, "value", ["event_type"]), ["event_type"], "value")
    ordered = rank_index(value_counts(t.customer, "c_acctbal", ["c_mktsegment"]), ["c_mktsegment"], "c_acctbal", few=0)
    some = t.customer.select("c_mktsegment").filter("c_mktsegment in ('BUILDING', 'MACHINERY')").distinct()
    one = events.quantiles(wanted).select(F.lit("type").alias("what"), F.col("event_type").alias("part"), *wanted)
    two = ordered.quantiles(wanted, some).select(F.lit("segment").alias("what"), F.col("c_mktsegment").alias("part"), *wanted)
    return rounded(one.unionByName(two), *wanted)


@query("""
with days(day) as (values (1), (2), (3)),
seen as (
  select c_custkey as k, day, case when day = 3 and c_custkey % 6 = 0 then 'MOVED' else c_mktsegment end as segment
  from customer, days
  where day = 1 or (day = 2 and c_custkey % 11 <> 0) or (day = 3 and c_custkey % 13 <> 0)),
spans as (  -- a version begins where the day before had nothing or something else
  select a.k, a.segment, a.day from seen a left join seen b on a.k = b.k and b.day = a.day - 1
  where b.k is null or b.segment <> a.segment)
select s.k as repository_id, s.segment, s.day as valid_from,
       (select min(d.day) from days d where d.day > s.day and not exists (
          select 1 from seen x where x.k = s.k and x.day = d.day and x.segment = s.segment)) as valid_to
from spans s""")
def history_hard_deletes(t: Tables) -> DataFrame:
    """Customers as repositories on three days: some vanish and come back, some change; the stored history closes what is gone."""
    path, keys = scratch_dir(t.spark, "deletes"), ["repository_id"]
    base = t.customer.select(F.col("c_custkey").alias("repository_id"), F.col("c_mktsegment").alias("segment"))
    moved = F.when(F.col("repository_id") % 6 == 0, "MOVED").otherwise(F.col("segment"))
    populations = [base, base.filter("repository_id % 11 <> 0"), base.filter("repository_id % 13 <> 0").withColumn("segment", moved)]
    for day, rows in enumerate(populations, 1):
        changes.snapshot_logged(
            t.spark, path, rows, keys, tables.range_bucket("repository_id", 500), "check",
            check_cols=["segment"], as_of=F.lit(day), hard_deletes="close",
        )
    return tables.read_table(t.spark, path).select(*keys, "segment", "valid_from", "valid_to")


@query("""
select 'before the switch' as seen, o_orderstatus as part, count(*) as n from orders where o_orderkey % 2 = 0 group by all
union all select 'after the switch', o_orderstatus, count(*) from orders group by all""")
def table_versions(t: Tables) -> DataFrame:
    """A full refresh whose job stops between writing and switching leaves the old table; after the switch the new one is there."""
    path = scratch_dir(t.spark, "versions")
    versions.overwrite_table(t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus"), path)
    folder = versions.write_version(t.orders.select("o_orderkey", "o_orderstatus"), path)

    def seen(when: str) -> DataFrame:
        table = tables.read_table(t.spark, path)
        return table.groupBy(F.lit(when).alias("seen"), F.col("o_orderstatus").alias("part")).agg(F.count(F.lit(1)).alias("n"))

    before = written(seen("before the switch"), "seen")
    versions.commit_version(t.spark, folder)
    return before.unionByName(seen("after the switch"))


@query("""
select strftime(o_orderdate, '%Y-%m') as _ingestion_date, o_orderkey, o_orderstatus from orders""")
def catalog_registration(t: Tables) -> DataFrame:
    """Orders as partitions of a registered table: months that come after the registration are found as well."""
    path, name = scratch_dir(t.spark, "registered"), "registered_" + scratch_dir(t.spark, "n")[-8:]
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("_ingestion_date"))
    for half in ("_ingestion_date < '1998'", "_ingestion_date >= '1998'", "false"):
        bronze.replace_partitions(rows.filter(half), path, ["_ingestion_date"])
        bronze.register_external(t.spark, name, path)
    table = t.spark.table(name).select("_ingestion_date", "o_orderkey", "o_orderstatus")
    out = written(table, "from-catalog")
    t.spark.sql(f"drop table {name}")
    return out


@query("""
select 'a table' as name, c_custkey as k, c_mktsegment as part from customer
union all select 'a keyed table', c_custkey, case when c_custkey % 2 = 0 then 'NEW' else c_mktsegment end from customer
union all select 'a history', c_custkey, c_mktsegment from customer
union all select 'a history', c_custkey, 'NEW' from customer where c_custkey % 2 = 0""")
def named_references(t: Tables) -> DataFrame:
    """The three kinds of stored tables, each written and read by its name: replaced, upserted, with history."""
    w = Warehouse(t.spark, scratch_dir(t.spark, "named"), Options(buckets=4))
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("part"))
    new = rows.filter("k % 2 = 0").withColumn("part", F.lit("NEW"))
    w.overwrite("a table", rows.limit(0))
    w.overwrite("a table", rows)
    for at, batch in enumerate((rows, new)):
        w.upsert("a keyed table", batch, "k")
        changes.snapshot_logged(
            t.spark, w.path("a history"), batch, ["k"], w.bucket("k"), "check", check_cols=["part"], as_of=F.lit(at)
        )
    return _stacked([w.read(n).select(F.lit(n).alias("name"), "k", "part") for n in ("a table", "a keyed table", "a history")])


@query(f"""with {STAR},{HEALTH},{SERIES},
ordered as (
  select 'repositories' as report, repo_name as part, row_number() over (order by repo_name) as position from health
  union all
  select 'months', month_year, row_number() over (order by month_year, repo_id) from series where repo_name = '{REPO}'
  union all
  select 'workload', list_last(string_split(repo_name, '/')),
         row_number() over (order by approximate_total_contributors, list_last(string_split(repo_name, '/'))) from health
  union all
  select 'changed lines', cast(pr_id as varchar),
         row_number() over (order by coalesce(additions, 0) + coalesce(deletions, 0) desc, pr_id) from fact_prs)
select * from ordered""")
def report_positions(t: Tables) -> DataFrame:
    """Where each row stands in four ordered reports: by repository, by month, by contributors, by changed lines."""
    star = Star(t)
    health = written(star.health, "health")
    found = {
        "repositories": (reports.repo_health(health), "repo_name"),
        "months": (reports.time_series(star.series, REPO), "month_year"),
        "workload": (reports.repo_workload(health), "short_name"),
        "changed lines": (reports.pr_complexity(star.prs), "pr_id"),
    }
    return _stacked(
        [
            numbered(df, "position").select(F.lit(name).alias("report"), F.col(part).cast("string").alias("part"), "position")
            for name, (df, part) in found.items()
        ]
    )


@query("""
select event_id, user_id, ts as valid_from, lead(ts) over (partition by user_id order by ts) as valid_to
from (select * from events qualify row_number() over (partition by user_id, ts order by event_id) = 1)""")
def history_from_stream(t: Tables) -> DataFrame:
    """Micro-batches into a type-2 table, one of them twice: every change of a user is a version, whatever batch it came in."""
    path = scratch_dir(t.spark, "stream-history")
    one = t.events.groupBy("user_id", "ts").agg(F.min("event_id").alias("event_id"))
    day = F.dayofmonth("ts")
    for number, some in ((0, day <= 10), (1, (day > 10) & (day <= 20)), (1, (day > 10) & (day <= 20)), (2, day > 20)):
        add_versions(t.spark, path, one.filter(some), ["user_id"], "ts", tables.hash_bucket(["user_id"], 4), number)
    return tables.read_table(t.spark, path).select("event_id", "user_id", "valid_from", "valid_to")


@query(f"""with {A_REPOS},{A_ISSUES}, v as (select *, {failing(ISSUE_CHECKS)} as f from a_issues)
select issue_id, array_to_string(f, ',') as failed, len(f) > 0 as is_quarantined from v""")
def rules_replay(t: Tables) -> DataFrame:
    """Issues judged by other rules first, one of them stricter and one missing; after the change only their verdicts count."""
    w = Warehouse(t.spark, scratch_dir(t.spark, "replay"), Options(buckets=4))
    first = [Rule("comments_few", "comments_count < 3"), *rules.ISSUE_RULES[:-1]]
    issues = t.a_issues().drop("true_repository_id")
    judged = evaluate_rules(validated.resolve_by_url(issues, t.a_repos()), first)
    w.upsert("validated/issues", judged, "issue_id", marks={"rules": rules_digest(first)})
    daily.judged_again(w, "issues", rules.ISSUE_RULES, "issue_id")
    return w.read("validated/issues").select("issue_id", F.array_join(FAILED, ",").alias("failed"), FLAG)


CHECKED = (
    Check("not_null", "orders", ("o_custkey",)),
    Check("unique", "orders", ("o_orderkey",)),
    Check("unique", "orders", ("o_custkey", "o_orderstatus")),
    Check("relationships", "orders", ("o_custkey",), "customers", ("c_custkey",)),
    Check("one_current", "history", ("c_custkey",)),
)


@query("""
with o as (select o_orderkey, case when o_orderkey % 7 <> 0 then o_custkey end as o_custkey, o_orderstatus from orders)
select 'not_null orders o_custkey' as "check", count(*) as violations from o where o_custkey is null
union all select 'unique orders o_orderkey', 0
union all select 'unique orders o_custkey,o_orderstatus',
  (select count(*) from (select 1 from o where o_custkey is not null group by o_custkey, o_orderstatus having count(*) > 1))
union all select 'relationships orders o_custkey',
  (select count(*) from o where o_custkey in (select c_custkey from customer where c_custkey % 10 = 0)
    or o_custkey not in (select c_custkey from customer))
union all select 'one_current history c_custkey', 0""")
def checks_by_deltas(t: Tables) -> DataFrame:
    """Violations kept over two days on which children lose their key, change it, and parents come later than children."""
    spark, root = t.spark, scratch_dir(t.spark, "checked")
    paths = {n: f"{root}/{n}" for n in ("orders", "customers", "history")}
    state = CheckState(spark, f"{root}/checks", paths, CHECKED, buckets=4)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    lost = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey"))
    moved = F.when(F.col("o_orderkey") % 5 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("o_custkey"))
    customers = t.customer.select("c_custkey", "c_mktsegment").filter("c_custkey % 10 <> 0")
    days = (
        (orders.withColumn("o_custkey", moved).filter("o_orderkey % 2 = 0"), customers.filter("c_custkey % 3 = 0")),
        (orders.withColumn("o_custkey", lost), customers.withColumn("c_mktsegment", F.lit("NEW"))),
    )
    for at, (children, parents) in enumerate(days):
        changes.upsert_logged(spark, paths["orders"], children, ["o_orderkey"], tables.hash_bucket(["o_orderkey"], 4))
        changes.upsert_logged(spark, paths["customers"], parents, ["c_custkey"], tables.hash_bucket(["c_custkey"], 4))
        changes.snapshot_logged(
            spark, paths["history"], parents, ["c_custkey"], tables.hash_bucket(["c_custkey"], 4), "check",
            check_cols=["c_mktsegment"], as_of=F.lit(at),
        )
        state.refresh()
    return state.violations()
