"""Deduplication, quality, history, star schema and KPI queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import scalars
from strata.operators import checks, quality, scd2
from strata.operators.dedup import dedup_latest as keep_latest
from strata.operators.quantiles import exact_median, exact_quantile, quantile_of_counts, value_counts
from strata.operators.spine import densify
from strata.plans import gold, kpis, rules, silver, staging, validated
from strata.session import scratch_dir, written
from strata.sources import tables
from verification import analogues as a
from verification.analogues import A_ISSUES, A_PRS, A_RELEASES, A_REPOS, A_REPOSITORIES, STAR, Tables, failing
from verification.registry import query

def as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


class Star:
    """The star schema over the given tables."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def repo_history(self) -> DataFrame:
        repos = self.t.a_repos().withColumn("_bronze_ingest_ts", as_of()).withColumn("_extraction_run_id", F.lit("r"))
        return scd2.scd2_apply(None, repos, ["repository_id"], "check", check_cols=["full_name"], as_of=as_of())

    @cached_property
    def dim_repositories(self) -> DataFrame:
        return gold.dim_repositories(self.repo_history, as_of())

    @cached_property
    def repos_current(self) -> DataFrame:
        return gold.dim_repositories_current(self.repo_history, as_of())

    @cached_property
    def issues_validated(self) -> DataFrame:
        issues = self.t.a_issues().drop("true_repository_id")
        return validated.validate_issues(issues.withColumn("repo_full_name", F.lit("")), self.t.a_repos())

    @cached_property
    def prs_validated(self) -> DataFrame:
        return validated.validate_pull_requests(self.t.a_prs(), self.t.a_repos())

    @cached_property
    def releases_validated(self) -> DataFrame:
        return quality.evaluate_rules(self.t.a_releases(), rules.RELEASE_RULES)

    @cached_property
    def issue_history(self) -> DataFrame:
        rows = quality.clean(self.issues_validated)
        return scd2.scd2_apply(None, rows, ["issue_id"], "timestamp", updated_at="updated_at")

    @cached_property
    def pr_history(self) -> DataFrame:
        rows = quality.clean(self.prs_validated)
        return scd2.scd2_apply(None, rows, ["pull_request_id"], "timestamp", updated_at="updated_at")

    def build_fact_issues(self) -> DataFrame:
        return gold.fact_issues(self.issue_history, self.repos_current, as_of())

    def build_fact_prs(self) -> DataFrame:
        return gold.fact_pull_requests(self.pr_history, self.repos_current, as_of())

    # health and series read the facts several times, so they read them as written tables of the columns they use

    @cached_property
    def fact_issues(self) -> DataFrame:
        used = ["repo_id", "author_user_id", "state", "created_date_key", "closed_date_key", "time_to_close_hours"]
        return written(self.build_fact_issues().select(*used), "fact-issues")

    @cached_property
    def fact_prs(self) -> DataFrame:
        days = ["created_date_key", "merged_date_key", "closed_date_key"]
        used = ["repo_id", "author_user_id", "state", *days, "time_to_merge_hours"]
        return written(self.build_fact_prs().select(*used), "fact-prs")

    @cached_property
    def dim_users(self) -> DataFrame:
        ties = ["user_login", "_extraction_run_id"]
        return gold.dim_users(self.issues_validated, self.prs_validated, self.releases_validated, as_of(), ties)

    @cached_property
    def bounds(self) -> DataFrame:
        return gold.calendar_bounds(self.fact_issues, self.fact_prs)

    @cached_property
    def health(self) -> DataFrame:
        return kpis.kpi_repo_health(self.fact_issues, self.fact_prs, self.dim_repositories)

    @cached_property
    def series(self) -> DataFrame:
        return kpis.kpi_time_series(self.fact_issues, self.fact_prs, self.dim_repositories, self.bounds)

    @cached_property
    def users(self) -> DataFrame:
        issues, prs = self.build_fact_issues(), self.build_fact_prs()
        return kpis.kpi_user_contributions(issues, prs, self.dim_repositories, self.dim_users)

    @cached_property
    def prs(self) -> DataFrame:
        return kpis.kpi_pr_complexity(self.build_fact_prs(), self.dim_repositories)

    @cached_property
    def stored_prs(self) -> DataFrame:
        """For reports that read the KPI table more than once."""
        used = ["pr_id", "merged_date_key", "time_to_merge_hours", "total_lines_changed", "pr_size_bucket"]
        return written(self.prs.select(*used, "changed_files", "commits_count"), "kpi-prs")


def hours(*cols: str) -> list:
    return [F.round(F.col(c).cast("double"), 6).alias(c) for c in cols]


# -- deduplication --------------------------------------------------------------------------------------------

DUP_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


@query(f"""
select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, {', '.join(c + ' desc' for c in DUP_COLS)}) as rn from lineitem) where rn = 1""")
def dedup_latest(t: Tables) -> DataFrame:
    return keep_latest(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"], tie_break=DUP_COLS)


@query("""
select o_custkey, o_orderdate, o_orderkey from (select *, row_number() over (partition by o_custkey
  order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1""")
def dedup_latest_single(t: Tables) -> DataFrame:
    newest = keep_latest(t.orders, ["o_custkey"], ["o_orderdate"], tie_break=["o_orderkey"])
    return newest.select("o_custkey", "o_orderdate", "o_orderkey")


# -- joins and sets -------------------------------------------------------------------------------------------


@query(f"""
with {A_REPOS},{A_PRS}
select pull_request_id, state, additions, deletions, commits_count, changed_files, review_comments_count,
       greatest(created_at, last_ship) as _bronze_ingest_ts
from a_prs left join a_pr_details using (pull_request_id, additions, deletions, commits_count, changed_files,
  review_comments_count)""")
def pr_enrich(t: Tables) -> DataFrame:
    heads = t.a_pr_heads().withColumn("_bronze_ingest_ts", F.col("created_at"))
    details = t.a_pr_details().withColumn("_bronze_ingest_ts", F.col("last_ship"))
    return staging.enrich_pull_requests(heads, details).select(
        "pull_request_id", "state", *staging.DETAIL_MEASURES, "_bronze_ingest_ts"
    )


@query(f"with {A_REPOS},{A_ISSUES} select issue_id, repository_id from a_issues")
def repo_resolve_url(t: Tables) -> DataFrame:
    return validated.resolve_by_url(t.a_issues(), t.a_repos()).select("issue_id", "repository_id")


@query(f"""
with {A_REPOS},{A_PRS}
select pull_request_id, canonical_repo_name, case when canonical_repo_name like 'ASIA/%' then null else repository_id end
  as repository_id from a_prs""")
def repo_resolve_name(t: Tables) -> DataFrame:
    """One region is missing from the dimension: its rows stay, unresolved."""
    known = t.a_repos().filter("owner_login <> 'ASIA'")
    return validated.resolve_by_name(t.a_prs(), known).select("pull_request_id", "canonical_repo_name", "repository_id")


@query(f"""
with {A_REPOS},{A_PRS},{A_ISSUES}
select repository_id as repo_id, user_id from a_prs union
select repository_id, case when is_pull_request then null else user_id end from a_issues""")
def union_distinct(t: Tables) -> DataFrame:
    prs = validated.resolve_by_name(t.a_prs(), t.a_repos()).select(F.col("repository_id").alias("repo_id"), "user_id")
    issues = validated.resolve_by_url(t.a_issues(), t.a_repos()).select(
        F.col("repository_id").alias("repo_id"), F.when(~F.col("is_pull_request"), F.col("user_id")).alias("user_id")
    )
    return prs.unionByName(issues).distinct()


# -- quality --------------------------------------------------------------------------------------------------


def verdict(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.array_join("dq_failed_rules", ",").alias("failed"), "is_quarantined")


def verdict_sql(ctes: str, table: str, key: str, rule_list: list[tuple[str, str]]) -> str:
    return (
        f"with {ctes}, v as (select {key}, {failing(rule_list)} as f from {table}) "
        f"select {key}, array_to_string(f, ',') as failed, len(f) > 0 as is_quarantined from v"
    )


@query(verdict_sql(f"{A_REPOS},{A_ISSUES}", "a_issues", "issue_id", a.ISSUE_CHECKS))
def dq_evaluate(t: Tables) -> DataFrame:
    return verdict(quality.evaluate_rules(t.a_issues(), rules.ISSUE_RULES), "issue_id")


@query(verdict_sql(f"{A_REPOS},{A_PRS}", "a_prs", "pull_request_id", a.PR_CHECKS))
def dq_pull_requests(t: Tables) -> DataFrame:
    return verdict(quality.evaluate_rules(t.a_prs(), rules.PULL_REQUEST_RULES), "pull_request_id")


@query(verdict_sql(A_REPOSITORIES, "a_repositories", "repository_id", a.REPOSITORY_CHECKS))
def dq_repositories(t: Tables) -> DataFrame:
    return verdict(validated.validate_repositories(t.a_repositories()), "repository_id")


@query(verdict_sql(A_RELEASES, "a_releases", "release_id", a.RELEASE_CHECKS))
def dq_releases(t: Tables) -> DataFrame:
    return verdict(quality.evaluate_rules(t.a_releases(), rules.RELEASE_RULES), "release_id")


LANGUAGE_CHECKS = [
    ("language_not_null", "language is not null"),
    ("bytes_positive", "bytes > 0"),
    ("repo_id_not_null", "repository_id is not null"),
]


@query(f"""
with {A_REPOS}, l as (
  select p_partkey as part, case when p_type <> 'PROMO' then p_type end as language, p_size - 2 as bytes,
         case when p_partkey % 30 < 25 then r.repository_id end as repository_id
  from part left join a_repos r on r.repository_id = p_partkey % 30),
v as (select part, {failing(LANGUAGE_CHECKS)} as f from l)
select part, array_to_string(f, ',') as failed, len(f) > 0 as is_quarantined from v""")
def dq_languages(t: Tables) -> DataFrame:
    repos = t.a_repos()
    names = repos.select((F.col("repository_id")).alias("slot"), F.col("full_name").alias("repo_full_name"))
    rows = t.part.select(
        F.col("p_partkey").alias("part"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("language"),
        (F.col("p_size") - 2).alias("bytes"),
        (F.col("p_partkey") % 30).alias("slot"),
    ).join(names, "slot", "left")
    return verdict(validated.validate_languages(rows, repos), "part")


@query(f"""
with {A_REPOS},{A_PRS}, v as (select *, {failing(a.PR_CHECKS)} as f from a_prs)
select case when len(f) > 0 then 'bad' else 'clean' end as side, pull_request_id, state from v""")
def dq_split(t: Tables) -> DataFrame:
    good, bad = quality.split_quarantine(quality.evaluate_rules(t.a_prs(), rules.PULL_REQUEST_RULES))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("side"), "pull_request_id", "state")

    return side(good, "clean").unionByName(side(bad, "bad"))


@query(f"""
with {A_REPOS},{A_PRS}, v as (select unnest({failing(a.PR_CHECKS)}) as rule from a_prs)
select rule, count(*) as failed_rows from v group by rule""")
def dq_summary(t: Tables) -> DataFrame:
    return quality.rule_summary(quality.evaluate_rules(t.a_prs(), rules.PULL_REQUEST_RULES))


@query(f"with {A_REPOS},{A_PRS} select pull_request_id, state from a_prs where additions is null")
def check_not_null(t: Tables) -> DataFrame:
    return checks.check_not_null(t.a_prs(), "additions").select("pull_request_id", "state")


@query("select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1")
def check_unique(t: Tables) -> DataFrame:
    return checks.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
select l_orderkey, l_linenumber, l_partkey from lineitem
where not exists (select 1 from part where p_partkey = l_partkey and p_size > 10)""")
def check_relationships(t: Tables) -> DataFrame:
    parents = t.part.filter("p_size > 10")
    orphans = checks.check_relationship(t.lineitem, "l_partkey", parents, "p_partkey")
    return orphans.select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
select l_orderkey, count(*) as n_rows from lineitem where l_returnflag = 'N' group by 1 having count(*) > 1""")
def check_one_current(t: Tables) -> DataFrame:
    """Lines as versions of their order: not returned means still open."""
    closed = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))
    return checks.check_one_current(t.lineitem.withColumn("valid_to", closed), ["l_orderkey"])


# -- history --------------------------------------------------------------------------------------------------

FMT = "%Y-%m-%d %H:%M:%S"


def dated(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query(f"""
with {A_REPOS},{A_PRS},
v as (select pull_request_id, 'open' as state, created_at as valid_from,
             case when updated_at > created_at then updated_at end as valid_to from a_prs
      union all
      select pull_request_id, state, updated_at, null from a_prs where updated_at > created_at)
select pull_request_id, state, strftime(valid_from, '{FMT}') as valid_from, strftime(valid_to, '{FMT}') as valid_to,
       md5(pull_request_id || '|' || strftime(valid_from, '{FMT}')) as scd_id from v""")
def scd2_timestamp(t: Tables) -> DataFrame:
    """Two batches into a stored history: every pull request as opened, then as last seen."""
    path, keys = scratch_dir(t.spark, "scd2ts"), ["pull_request_id"]
    bucket = tables.range_bucket("pull_request_id", 40_000)
    prs = t.a_prs()
    first = prs.select(*keys, F.lit("open").alias("state"), F.col("created_at").alias("updated_at"))
    then = prs.select(*keys, "state", "updated_at")
    tables.snapshot_by_timestamp(t.spark, path, first, keys, "updated_at", bucket, "run-1")
    tables.snapshot_by_timestamp(t.spark, path, then, keys, "updated_at", bucket, "run-2")
    return tables.read_table(t.spark, path).select(*keys, "state", dated("valid_from"), dated("valid_to"), "scd_id")


@query("""
with s as (select c_custkey as k, c_acctbal as v1, c_mktsegment as d1, c_nationkey % 5 <> 0 as in1,
           case when c_custkey % 4 = 0 then c_acctbal + 1 else c_acctbal end as v2,
           case when c_custkey % 6 = 0 then null else c_mktsegment end as d2, c_nationkey % 7 <> 0 as in2 from customer),
f as (select *, v1 is distinct from v2 or d1 is distinct from d2 as diff from s)
select k as repository_id, v1 as stars, d1 as description, '2024-01-01' as valid_from,
       case when in2 and diff then '2024-01-02' end as valid_to from f where in1
union all
select k, v2, d2, '2024-01-02', null from f where in2 and (not in1 or diff)""")
def scd2_check(t: Tables) -> DataFrame:
    """Customers as repositories, seen on two days: some change, some appear, some are missing on day two."""
    path, keys = scratch_dir(t.spark, "scd2ck"), ["repository_id"]
    bucket = tables.hash_bucket(keys, 8)
    base = t.customer.select(
        F.col("c_custkey").alias("repository_id"),
        F.col("c_acctbal").alias("stars"),
        F.col("c_mktsegment").alias("description"),
        "c_nationkey",
    )
    first = base.filter("c_nationkey % 5 <> 0").drop("c_nationkey")
    then = base.filter("c_nationkey % 7 <> 0").select(
        "repository_id",
        F.when(F.col("repository_id") % 4 == 0, F.col("stars") + 1).otherwise(F.col("stars")).alias("stars"),
        F.when(F.col("repository_id") % 6 != 0, F.col("description")).alias("description"),
    )
    for day, batch in (("2024-01-01", first), ("2024-01-02", then)):
        at = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
        tables.snapshot_by_check(t.spark, path, batch, keys, ["stars", "description"], at, bucket, day)
    history = tables.read_table(t.spark, path)
    return history.select(
        *keys,
        "stars",
        "description",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"),
    )


EVENT_VERSIONS = """
c as (select *, lag(event_type) over (partition by user_id order by ts, event_id) as prev from events),
v as (select user_id, event_type, ts as valid_from,
             lead(ts) over (partition by user_id order by ts, event_id) as valid_to
      from c where prev is null or prev <> event_type)"""


def event_versions(t: Tables) -> DataFrame:
    log = t.events.select("user_id", "event_type", "ts", "event_id")
    return scd2.scd2_from_history(log, ["user_id"], "ts", ["event_type"], tie_break=["event_id"])


@query(f"with {EVENT_VERSIONS} select user_id, event_type, valid_from, valid_to, valid_to is null as is_current from v")
def scd2_from_history(t: Tables) -> DataFrame:
    columns = {"user_id": "user_id", "event_type": "event_type"}
    return scd2.version_dimension(event_versions(t), columns).select(
        "user_id", "event_type", "valid_from", "valid_to", "is_current"
    )


@query("""
select event_id, user_id, ts as valid_from, lead(ts) over (partition by user_id order by ts, event_id) as valid_to
from events""")
def scd2_from_history_timestamp(t: Tables) -> DataFrame:
    log = t.events.select("user_id", "ts", "event_id")
    versions = scd2.scd2_from_history(log, ["user_id"], "ts", tie_break=["event_id"])
    return versions.select("event_id", "user_id", "valid_from", "valid_to")


@query(f"with {EVENT_VERSIONS} select user_id, event_type, valid_from from v where valid_to is null")
def scd2_current(t: Tables) -> DataFrame:
    return scd2.scd2_current(event_versions(t)).select("user_id", "event_type", "valid_from")


@query(f"""
with {EVENT_VERSIONS} select user_id, event_type, valid_from from v
where valid_from <= timestamp '2024-01-15' and (valid_to is null or valid_to > timestamp '2024-01-15')""")
def scd2_as_of(t: Tables) -> DataFrame:
    moment = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return scd2.scd2_as_of(event_versions(t), moment).select("user_id", "event_type", "valid_from")


@query(f"""
with {A_REPOS},{A_ISSUES}, v as (select *, {failing(a.ISSUE_CHECKS)} as f from a_issues)
select issue_id, state, repository_id, array_to_string(f, ',') as failed, len(f) > 0 as is_quarantined,
       case when len(f) = 0 then updated_at end as valid_from,
       case when len(f) = 0 then 'history' else 'quarantine' end as record_source
from v where not is_pull_request""")
def silver_current(t: Tables) -> DataFrame:
    star = Star(t)

    def labelled(df: DataFrame) -> DataFrame:
        return df.withColumn("labels", F.array(F.col("title")))

    view = silver.issues_current(labelled(star.issue_history), labelled(star.issues_validated))
    return view.select(
        "issue_id",
        "state",
        "repository_id",
        F.array_join("dq_failed_rules", ",").alias("failed"),
        "is_quarantined",
        "valid_from",
        "record_source",
    )


def judged(checks: str, table: str, key: str, dated: str) -> str:
    """SQL of a current-state view: clean rows dated, failing ones with their reasons."""
    return f"""v as (select *, {checks} as f from {table})
select {key}, array_to_string(f, ',') as failed, len(f) > 0 as is_quarantined,
       case when len(f) = 0 then {dated} end as valid_from,
       case when len(f) = 0 then 'history' else 'quarantine' end as record_source"""


@query(f"""
with {A_REPOS},{A_PRS}, {judged(failing(a.PR_CHECKS), "a_prs", "pull_request_id, state, additions, changed_files", "updated_at")}
from v""")
def silver_pull_requests(t: Tables) -> DataFrame:
    star = Star(t)

    def filled(df: DataFrame) -> DataFrame:
        texts = {c: F.lit("") for c in ("merge_commit_sha", "head_branch", "base_branch")}
        return df.withColumns({**texts, "is_draft": F.lit(False)})

    view = silver.pull_requests_current(filled(star.pr_history), filled(star.prs_validated))
    return view.select(
        "pull_request_id", "state", "additions", "changed_files",
        F.array_join("dq_failed_rules", ",").alias("failed"), "is_quarantined", "valid_from", "record_source",
    )


@query(f"""
with {a.A_REPOSITORIES}, {judged(failing(a.REPOSITORY_CHECKS), "a_repositories", "repository_id, full_name, stars, forks", "timestamp '2024-02-01'")}
from v""")
def silver_repositories(t: Tables) -> DataFrame:
    rows = quality.evaluate_rules(t.a_repositories(), rules.REPOSITORY_RULES)
    missing = [c for c in silver.REPOSITORY_COLUMNS if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in missing})
    moment = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    history = scd2.scd2_apply(None, quality.clean(rows), ["repository_id"], "check", check_cols=["stars"], as_of=moment)
    return silver.repositories_current(history, rows).select(
        "repository_id", "full_name", "stars", "forks",
        F.array_join("dq_failed_rules", ",").alias("failed"), "is_quarantined", "valid_from", "record_source",
    )


@query(f"""
with {A_REPOS}, p as (
  select p_partkey as release_id, p_brand as tag_name, p_partkey % 30 as n, p_size from part)
select release_id, tag_name, repository_id, p_size >= 3 as published_after from p
left join a_repos on n = repository_id""")
def releases_resolve(t: Tables) -> DataFrame:
    """Releases joined to their repository by its full name; every sixth names one that isn't known."""
    names = t.a_repos().select(F.col("repository_id").alias("n"), F.col("full_name").alias("_repo_full_name"))
    plain = t.a_releases().drop("repository_id").withColumn("n", F.col("release_id") % 30).join(names, "n", "left")
    named = plain.withColumn("_repo_full_name", F.coalesce("_repo_full_name", F.lit("no/where"))).drop("n")
    judged_rows = validated.validate_releases(named, t.a_repos())
    late = ~F.array_contains("dq_failed_rules", "published_after_created")
    return judged_rows.select("release_id", "tag_name", "repository_id", late.alias("published_after"))


LATE_DETAILS = f"""
late as (
  select pr_id, case when pr_id % 2 = 0 then additions end as before, additions as after from fact_prs)"""


@query(f"with {STAR},{LATE_DETAILS} select pr_id, before, after, 1 as versions from late")
def fact_late_details(t: Tables) -> DataFrame:
    """Details of every second pull request come a day later, with nothing else changed: no new version, new measures."""
    star, key, day = Star(t), "pull_request_id", F.expr("interval 1 day")
    clean = quality.clean(star.prs_validated)
    measures = list(staging.DETAIL_MEASURES)
    odd = F.col(key) % 2 == 1
    first = clean.withColumns({c: F.when(~odd, F.col(c)) for c in measures})
    then = clean.filter(odd).withColumn("_bronze_ingest_ts", F.col("_bronze_ingest_ts") + day)
    path, bucket = scratch_dir(t.spark, "late"), tables.hash_bucket([key], 4)
    before = None
    for run, batch in (("day-1", first), ("day-2", then)):
        refresh = [*measures, "_bronze_ingest_ts"]
        tables.snapshot_by_timestamp(t.spark, path, batch, [key], "updated_at", bucket, run, refresh)
        fact = gold.fact_pull_requests(tables.read_open(t.spark, path), star.repos_current, as_of())
        rows = written(fact.select("pr_id", F.col("additions").alias("before" if before is None else "after")), "late-fact")
        before = rows if before is None else before.join(rows, "pr_id")
    versions = tables.read_table(t.spark, path).groupBy(F.col(key).alias("pr_id")).agg(F.count("*").cast("int").alias("versions"))
    return before.join(versions, "pr_id").select("pr_id", "before", "after", "versions")


# -- star schema ----------------------------------------------------------------------------------------------


@query(f"""
with {STAR}, b as (
  select min(k) as lo, max(k) as hi from (
    select unnest([created_date_key, closed_date_key]) as k from fact_issues union all
    select unnest([created_date_key, merged_date_key, closed_date_key]) as k from fact_prs)),
d as (select unnest(generate_series(strptime(cast(lo as varchar), '%Y%m%d'), strptime(cast(hi as varchar), '%Y%m%d'),
      interval 1 day)) as day from b)
select cast(strftime(day, '%Y%m%d') as int) as date_key, strftime(day, '%Y-%m-%d') as date_actual,
       cast(year(day) as int) as year, cast(quarter(day) as int) as quarter, cast(month(day) as int) as month,
       cast(weekofyear(day) as int) as week_of_year, cast(dayofweek(day) + 1 as int) as day_of_week from d""")
def dim_date(t: Tables) -> DataFrame:
    star = Star(t)
    days = gold.calendar(gold.calendar_bounds(star.build_fact_issues(), star.build_fact_prs()))
    return days.withColumn("date_actual", F.date_format("date_actual", "yyyy-MM-dd"))


@query(f"""
with o as (select *, row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) as rn from orders),
c as (select *, lag(o_orderpriority) over (partition by o_custkey order by o_orderdate) as prev from o where rn = 1),
v as (select o_custkey, o_orderpriority, o_orderdate as valid_from,
             lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as valid_to
      from c where prev is null or prev <> o_orderpriority)
select md5(o_custkey || '|' || strftime(valid_from, '{FMT}')) as repository_sk, o_custkey as repo_id,
       o_orderpriority as primary_language, valid_to is null as is_current, valid_from, valid_to from v""")
def dim_repositories(t: Tables) -> DataFrame:
    """Version dimension of a change log: a customer's orders as states of a repository."""
    log = t.orders.select(
        F.col("o_custkey").alias("repository_id"),
        F.col("o_orderpriority").alias("primary_language"),
        F.col("o_orderdate").alias("seen_at"),
        "o_orderkey",
    )
    daily = keep_latest(log, ["repository_id", "seen_at"], ["o_orderkey"])
    history = scd2.scd2_from_history(daily, ["repository_id"], "seen_at", ["primary_language"])
    whole = history.select(
        "*", F.lit("").alias("full_name"), F.lit("").alias("owner_login"), F.lit("").alias("license"),
        F.col("seen_at").alias("_bronze_ingest_ts"), F.lit("").alias("_extraction_run_id"),
    )
    return gold.dim_repositories(whole, as_of()).select(
        "repository_sk", "repo_id", "primary_language", "is_current", "valid_from", "valid_to"
    )


@query(f"""
with {A_REPOS} select md5(cast(repository_id as varchar)) as repository_sk, repository_id as repo_id,
  full_name as repo_name, owner_login, primary_language, license as license_name from a_repos""")
def dim_repositories_current(t: Tables) -> DataFrame:
    return Star(t).repos_current.drop("_bronze_ingest_ts", "_extraction_run_id", "_gold_update_ts")


USERS = f"""
v_releases as (select *, {failing(a.RELEASE_CHECKS)} as failed from a_releases),
people as (
  select user_id, user_login, _bronze_ingest_ts as ts, _extraction_run_id as run from v_issues where len(failed) = 0
  union all select user_id, user_login, _bronze_ingest_ts, _extraction_run_id from v_prs where len(failed) = 0
  union all select author_id, author_login, _bronze_ingest_ts, _extraction_run_id from v_releases where len(failed) = 0),
dim_users as (
  select * exclude (rn) from (
    select *, row_number() over (partition by user_id order by ts desc, user_login desc, run desc) as rn
    from people where user_login is not null and user_id is not null) where rn = 1)"""


@query(f"""
with {STAR},{A_RELEASES},{USERS}
select md5(cast(user_id as varchar)) as user_sk, user_id, user_login, 'User' as user_type, ts as _bronze_ingest_ts
from dim_users""")
def dim_users(t: Tables) -> DataFrame:
    return Star(t).dim_users.drop("_extraction_run_id", "_gold_update_ts")


@query(f"with {STAR} select * from fact_issues")
def fact_issues(t: Tables) -> DataFrame:
    fact = Star(t).build_fact_issues().drop("_bronze_ingest_ts", "_extraction_run_id", "_gold_update_ts")
    return fact.withColumns({"time_to_close_hours": hours("time_to_close_hours")[0]})


@query(f"with {STAR} select * from fact_prs")
def fact_pull_requests(t: Tables) -> DataFrame:
    fact = Star(t).build_fact_prs().drop("_bronze_ingest_ts", "_extraction_run_id", "_gold_update_ts")
    merge, close = hours("time_to_merge_hours", "time_to_close_hours")
    return fact.withColumns({"time_to_merge_hours": merge, "time_to_close_hours": close})


@query(f"""
with {A_REPOS},{A_RELEASES}, v as (select *, {failing(a.RELEASE_CHECKS)} as f from a_releases)
select md5(cast(release_id as varchar)) as release_sk, md5(cast(repository_id as varchar)) as repository_sk,
       md5(cast(author_id as varchar)) as author_user_sk, release_id, author_id as author_user_id,
       cast(strftime(published_at, '%Y%m%d') as int) as published_date_key, tag_name, is_prerelease
from v where len(f) = 0""")
def fact_releases(t: Tables) -> DataFrame:
    star = Star(t)
    fact = gold.fact_releases(star.releases_validated, star.repos_current, as_of())
    return fact.drop("_bronze_ingest_ts", "_extraction_run_id", "_gold_update_ts")


# -- KPIs -----------------------------------------------------------------------------------------------------

# one relation of all work items, one filtered aggregate for each measure
HEALTH = """
work as (
  select 'issue' as what, repo_id, state, author_user_id, time_to_close_hours as hours from fact_issues
  union all select 'pr', repo_id, state, author_user_id, time_to_merge_hours from fact_prs),
health as (
  select repository_id as repo_id, full_name as repo_name,
         count(*) filter (what = 'issue') as total_issues,
         count(*) filter (what = 'issue' and state = 'open') as open_issues,
         round(median(hours) filter (what = 'issue'), 6) as median_time_to_close_hours,
         count(*) filter (what = 'pr') as total_prs,
         count(*) filter (what = 'pr' and state = 'open') as open_prs,
         round(median(hours) filter (what = 'pr'), 6) as median_time_to_merge_hours,
         avg(case when state is distinct from 'open' then 1.0::double else 0.0 end) filter (what = 'issue')
           as closed_to_open_issue_ratio,
         avg(case when state is distinct from 'open' then 1.0::double else 0.0 end) filter (what = 'pr') as merged_pr_ratio,
         count(distinct (what, author_user_id)) filter (author_user_id is not null) as approximate_total_contributors
  from a_repos left join work on repo_id = repository_id group by repository_id, full_name)"""

HEALTH_MEDIANS = ("median_time_to_close_hours", "median_time_to_merge_hours")


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in cols})


@query(f"with {STAR},{HEALTH} select * from health")
def kpi_repo_health(t: Tables) -> DataFrame:
    return rounded(Star(t).health, *HEALTH_MEDIANS)


# dated milestones beside every month of every repository, pivoted by filtered aggregates
SERIES = """
dated as (
  select repo_id, unnest(['opened issue', 'closed issue', 'end']) as what,
         unnest([created_date_key, closed_date_key, null]) as day, unnest([null, time_to_close_hours, null]) as hours
  from fact_issues
  union all
  select repo_id, unnest(['opened pr', 'merged pr', 'end']), unnest([created_date_key, merged_date_key, closed_date_key]),
         unnest([null, time_to_merge_hours, null]) from fact_prs),
spans as (
  select min(make_date(day // 10000, day // 100 % 100, 1)) as first_month,
         max(make_date(day // 10000, day // 100 % 100, 1)) as last_month from dated where day is not null),
months as (
  select strftime(unnest(generate_series(first_month::timestamp, last_month::timestamp, interval 1 month)), '%Y-%m')
         as month_year from spans),
series as (
  select repository_id as repo_id, full_name as repo_name, month_year,
         count(*) filter (what = 'opened issue') as issues_opened,
         count(*) filter (what = 'closed issue') as issues_closed,
         round(median(hours) filter (what = 'closed issue'), 6) as median_time_to_close_hours,
         count(*) filter (what = 'opened pr') as prs_opened,
         count(*) filter (what = 'merged pr') as prs_merged,
         round(median(hours) filter (what = 'merged pr'), 6) as median_time_to_merge_hours
  from (a_repos cross join months)
  left join dated on dated.repo_id = repository_id and month_year = printf('%04d-%02d', day // 10000, day // 100 % 100)
  group by repository_id, full_name, month_year)"""


@query(f"with {STAR},{SERIES} select * from series")
def kpi_time_series(t: Tables) -> DataFrame:
    return rounded(Star(t).series, *HEALTH_MEDIANS)


@query(f"with {STAR},{SERIES} select repo_id, repo_name, month_year from series")
def date_spine_densify(t: Tables) -> DataFrame:
    star = Star(t)
    bounds = gold.calendar_bounds(star.build_fact_issues(), star.build_fact_prs())
    calendar = kpis.limits(bounds)
    return densify(kpis.current_repos(star.dim_repositories), calendar.getField("start"), calendar.getField("end"))


# one row for each thing a user did, summed once
CONTRIBUTIONS = """
deeds as (
  select repo_id, author_user_id as who, [1, 0, 0, comment_count, 0, 0] as did from fact_issues
  union all
  select repo_id, author_user_id, [0, 1, (merged_date_key is not null)::int, comment_count, additions, deletions] from fact_prs),
tallied as (
  select repo_id, who, unnest(range(1, 7)) as measure, unnest(did) as amount from deeds),
summed as (
  select repo_id, who, measure,
         coalesce(sum(amount) filter (repo_id is not null and who is not null), 0)::bigint as amount
  from tallied group by all),
users as (
  select full_name as repo_name, summed.repo_id, who as user_id, user_login as github_username,
         max(amount) filter (measure = 1) as total_issues_opened, max(amount) filter (measure = 2) as total_prs_opened,
         max(amount) filter (measure = 3) as total_prs_merged, max(amount) filter (measure = 4) as total_comments,
         max(amount) filter (measure = 5) as total_additions, max(amount) filter (measure = 6) as total_deletions
  from summed left join a_repos on repository_id = repo_id left join dim_users on dim_users.user_id = who
  group by all)"""


@query(f"with {STAR},{A_RELEASES},{USERS},{CONTRIBUTIONS} select * from users")
def kpi_user_contributions(t: Tables) -> DataFrame:
    return Star(t).users


# the size of a pull request by a table of limits
COMPLEXITY = """
limits(pr_size_bucket, least, below) as (
  values ('Small', -1e18, 100), ('Medium', 100, 500), ('Large', 500, 1000), ('XL', 1000, 1e18)),
changed as (
  select f.*, list_sum(list_filter([additions, deletions, 0], lambda x: x is not null))::bigint as total_lines_changed
  from fact_prs f),
prs as (
  select pr_id, full_name as repo_name, repo_id, author_user_id, created_date_key, merged_date_key, time_to_merge_hours,
         additions, deletions, changed_files, commits_count, total_lines_changed,
         additions / nullif(total_lines_changed, 0) as additions_ratio,
         deletions / nullif(total_lines_changed, 0) as deletions_ratio, pr_size_bucket
  from changed left join a_repos on repository_id = repo_id
  left join limits on total_lines_changed >= least and total_lines_changed < below)"""


@query(f"with {STAR},{COMPLEXITY} select * from prs")
def kpi_pr_complexity(t: Tables) -> DataFrame:
    return rounded(Star(t).prs, "time_to_merge_hours")


# -- quantiles and scalars ------------------------------------------------------------------------------------


@query("""
select l_returnflag, l_linestatus, round(median(l_extendedprice), 4) as median_price from lineitem group by 1, 2""")
def group_median(t: Tables) -> DataFrame:
    """Few, very large groups: the case the built-in exact median cannot split."""
    keys = ["l_returnflag", "l_linestatus"]
    median = exact_median(t.lineitem, keys, "l_extendedprice", "median_price")
    return median.withColumn("median_price", F.round("median_price", 4))


@query("""
select event_type, round(quantile_cont(value, 0.99), 6) as p99 from events group by 1""")
def group_quantile(t: Tables) -> DataFrame:
    return rounded(exact_quantile(t.events, ["event_type"], "value", 0.99, "p99"), "p99")


EXTREMES = {
    "tiny": ("o_totalprice * 1e-12", 1e-12),
    "huge": ("o_totalprice * 1e12", 1e12),
    "negative": ("-o_totalprice", 1.0),
    "outlier": ("case when o_orderkey = (select min(o_orderkey) from orders) then 1e15 else o_totalprice end", 1.0),
    "nan": ("case when o_orderkey % 3 = 0 then cast('nan' as double) else o_totalprice end", 1.0),
    "decimal": ("cast(cast(o_totalprice as decimal(28, 10)) / 1000 as decimal(28, 10))", 1e-3),
}


@query(
    " union all ".join(
        f"""select '{kind}' as kind, o_orderstatus, round(quantile_cont(cast({value} as double), 0.5) / {unit}, 4) as median,
        round(quantile_cont(cast({value} as double), 0.9) / {unit}, 4) as p90 from orders group by all"""
        for kind, (value, unit) in EXTREMES.items()
    )
)
def quantile_extremes(t: Tables) -> DataFrame:
    """Values of every size and sign, one outlier, NaN above all others, and decimals."""
    least = t.orders.agg(F.min("o_orderkey")).scalar()
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    values = {
        "tiny": price * 1e-12,
        "huge": price * 1e12,
        "negative": -price,
        "outlier": F.when(key == least, F.lit(1e15)).otherwise(price),
        "nan": F.when(key % 3 == 0, F.lit(float("nan"))).otherwise(price),
        "decimal": (price.cast("decimal(28, 10)") / 1000).cast("decimal(28, 10)"),
    }
    out = None
    for kind, value in values.items():
        counts = value_counts(t.orders.select("o_orderstatus", value.alias("v")), "v", ["o_orderstatus"])
        median = quantile_of_counts(counts, ["o_orderstatus"], "v", 0.5, "median")
        high = quantile_of_counts(counts, ["o_orderstatus"], "v", 0.9, "p90")
        scaled = [F.round(F.col(c) / EXTREMES[kind][1], 4).alias(c) for c in ("median", "p90")]
        rows = median.join(high, "o_orderstatus").select(F.lit(kind).alias("kind"), "o_orderstatus", *scaled)
        out = rows if out is None else out.unionByName(rows)
    return out


@query("""
select o_orderkey, md5(cast(o_orderkey as varchar)) as sk, sha256(o_orderpriority) as sha,
       cast(strftime(o_orderdate, '%Y%m%d') as int) as day_key, strftime(o_orderdate, '%Y-%m') as month_year,
       cast(year(o_orderdate) as int) as y, cast(quarter(o_orderdate) as int) as q, cast(month(o_orderdate) as int) as m,
       cast(weekofyear(o_orderdate) as int) as w, cast(dayofweek(o_orderdate) + 1 as int) as dow,
       string_split(o_orderpriority, '-')[-1] as last_part, replace(o_orderpriority, '-', '_') as slug,
       'u' || o_custkey || ' · ' || o_orderstatus as label, o_custkey / nullif(o_orderkey % 5, 0) as share,
       cast(floor(epoch(o_orderdate)) as bigint) as unix, coalesce(nullif(o_orderstatus, 'P'), 'none') as status,
       cast(date_diff('hour', timestamp '1995-01-01', o_orderdate) as double) as since_hours,
       strftime(o_orderdate + interval 3 day, '%Y-%m-%d') as later
from orders""")
def scalar_suite(t: Tables) -> DataFrame:
    start = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
    dashed = F.replace("o_orderpriority", F.lit("-"), F.lit("/"))
    return t.orders.select(
        "o_orderkey",
        scalars.surrogate_key("o_orderkey").alias("sk"),
        F.sha2("o_orderpriority", 256).alias("sha"),
        scalars.date_key("o_orderdate").alias("day_key"),
        scalars.month_of_key(scalars.date_key("o_orderdate")).alias("month_year"),
        F.year("o_orderdate").alias("y"),
        F.quarter("o_orderdate").alias("q"),
        F.month("o_orderdate").alias("m"),
        F.weekofyear("o_orderdate").alias("w"),
        F.dayofweek("o_orderdate").alias("dow"),
        scalars.short_name(dashed).alias("last_part"),
        scalars.repo_slug(dashed).alias("slug"),
        scalars.contributor_label(F.concat(F.lit("u"), F.col("o_custkey")), "o_orderstatus").alias("label"),
        scalars.ratio("o_custkey", F.col("o_orderkey") % 5).alias("share"),
        F.unix_timestamp("o_orderdate").alias("unix"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("none")).alias("status"),
        scalars.hours_between(start, "o_orderdate").cast("double").alias("since_hours"),
        F.date_format(F.col("o_orderdate") + F.expr("interval 3 days"), "yyyy-MM-dd").alias("later"),
    )
