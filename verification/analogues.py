"""The given tables seen as repository records, once as Spark frames and once as SQL for the cross-check.

region/nation -> repositories, customer -> users, orders -> pull requests, lineitem -> pull-request details,
events -> issues and change logs, part -> releases.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import written

URL_PREFIX = "https://api.github.com/repos/"


# column types of the given tables, so that reading one needs no look into its files
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class Tables:
    """The given Parquet tables by name, and the views built over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")
        setattr(self, name, df)
        return df

    def a_repos(self) -> DataFrame:
        joined = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(
            F.col("n_nationkey").cast("bigint").alias("repository_id"),
            F.col("r_name").alias("owner_login"),
            F.col("n_name").alias("repo_name"),
            F.concat_ws("/", "r_name", "n_name").alias("full_name"),
            F.concat(F.lit("lang"), F.col("n_regionkey").cast("string")).alias("primary_language"),
            F.lit("MIT").alias("license"),
        )

    def a_pr_details(self) -> DataFrame:
        return self.lineitem.groupBy(F.col("l_orderkey").alias("pull_request_id")).agg(
            (F.sum("l_quantity") * 4).cast("bigint").alias("additions"),
            F.sum("l_linenumber").alias("deletions"),
            F.count_distinct("l_partkey").alias("changed_files"),
            F.count(F.lit(1)).alias("commits_count"),
            F.count_if(F.col("l_returnflag") == "R").alias("review_comments_count"),
            F.max("l_shipdate").alias("last_ship"),
        )

    def a_pr_heads(self) -> DataFrame:
        """Pull requests without their details: what the list call would give."""
        named = self.orders.join(
            self.customer.select("c_custkey", "c_name", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
        )
        repos = self.a_repos().select("repository_id", "full_name")
        named = named.join(repos, F.col("c_nationkey") == F.col("repository_id"))
        return named.select(
            F.col("o_orderkey").alias("pull_request_id"),
            (F.col("o_orderkey") % 1000).cast("int").alias("pr_number"),
            F.col("o_orderpriority").alias("title"),
            F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
            F.col("o_custkey").alias("user_id"),
            F.col("c_name").alias("user_login"),
            F.col("o_orderdate").alias("created_at"),
            F.col("full_name").alias("canonical_repo_name"),
            F.col("o_orderstatus").alias("status"),
        )

    def a_prs(self) -> DataFrame:
        joined = self.a_pr_heads().join(self.a_pr_details(), "pull_request_id", "left")
        updated = F.greatest("created_at", "last_ship")
        return (
            joined.withColumn("closed_at", F.when(F.col("status").isin("F", "P"), F.col("last_ship")))
            .withColumn("merged_at", F.when(F.col("status") == "P", F.col("last_ship")))
            .withColumn("updated_at", updated)
            .withColumn("_bronze_ingest_ts", updated + F.expr("interval 1 day"))
            .withColumn("_extraction_run_id", F.date_format(updated, "yyyy-MM"))
            .drop("status", "last_ship")
        )

    def a_issues(self) -> DataFrame:
        users = self.customer.select("c_custkey", "c_name", "c_nationkey")
        repos = self.a_repos().select("repository_id", "full_name")
        joined = self.events.join(users, F.col("user_id") == F.col("c_custkey")).join(
            repos, F.col("c_nationkey") == F.col("repository_id")
        )
        done = F.col("event_type").isin("purchase", "signup")
        hours = F.make_dt_interval(F.lit(0), F.floor("value").cast("int"))
        closed = F.when(done, F.col("ts") + hours)
        comments = F.get_json_object("props", "$.k").cast("int")
        return joined.select(
            F.col("event_id").alias("issue_id"),
            (F.col("event_id") % 500).cast("int").alias("issue_number"),
            F.col("event_type").alias("title"),
            F.when(done, "closed").otherwise("open").alias("state"),
            "user_id",
            F.col("c_name").alias("user_login"),
            F.col("ts").alias("created_at"),
            F.coalesce(closed, F.col("ts")).alias("updated_at"),
            closed.alias("closed_at"),
            comments.alias("comments_count"),
            F.concat(F.lit(URL_PREFIX), F.col("full_name")).alias("repository_url"),
            (F.col("event_type") == "error").alias("is_pull_request"),
            (F.coalesce(closed, F.col("ts")) + F.expr("interval 1 day")).alias("_bronze_ingest_ts"),
            F.date_format("ts", "yyyy-MM-dd").alias("_extraction_run_id"),
            F.col("repository_id").alias("true_repository_id"),
        )

    def a_releases(self) -> DataFrame:
        joined = self.part.join(
            self.customer.select("c_custkey", "c_name"), F.col("p_partkey") == F.col("c_custkey"), "left"
        )
        start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        return joined.select(
            F.col("p_partkey").alias("release_id"),
            F.col("p_brand").alias("tag_name"),
            F.col("p_name").alias("release_name"),
            (F.col("p_size") < 5).alias("is_prerelease"),
            F.col("p_partkey").alias("author_id"),
            F.concat(F.col("c_name"), F.lit("-"), F.col("p_type")).alias("author_login"),
            start.alias("created_at"),
            (start + F.make_dt_interval(F.col("p_size") - 3)).alias("published_at"),
            (F.col("p_partkey") % 25).alias("repository_id"),
            (start + F.make_dt_interval(F.col("p_size"))).alias("_bronze_ingest_ts"),
            F.lit("releases").alias("_extraction_run_id"),
        )

    def a_repositories(self) -> DataFrame:
        """Customers as repositories with counters, for the repository rules."""
        activity = self.orders.groupBy(F.col("o_custkey").alias("repository_id")).agg(
            F.count(F.lit(1)).alias("forks"),
            F.min("o_orderdate").alias("created_at"),
            F.max("o_orderdate").alias("updated_at"),
        )
        named = self.customer.select(
            F.col("c_custkey").alias("repository_id"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("full_name"),
            F.floor("c_acctbal").alias("stars"),
        )
        return (
            named.join(activity, "repository_id", "left")
            .withColumn("watchers", F.col("forks") - 5)
            .withColumn("open_issues", F.col("forks") * 2)
        )


class Kept(Tables):
    """The same, for queries that read issues and pull requests many times: those are computed once and written."""

    @cached_property
    def kept_issues(self) -> DataFrame:
        return written(super().a_issues(), "a-issues")

    @cached_property
    def kept_prs(self) -> DataFrame:
        return written(super().a_prs(), "a-prs")

    def a_issues(self) -> DataFrame:
        return self.kept_issues

    def a_prs(self) -> DataFrame:
        return self.kept_prs


A_REPOS = """
a_repos as (
  select cast(n_nationkey as bigint) as repository_id, r_name as owner_login, n_name as repo_name,
         r_name || '/' || n_name as full_name, 'lang' || n_regionkey as primary_language, 'MIT' as license
  from nation join region on n_regionkey = r_regionkey)"""

A_PRS = """
a_pr_details as (
  select l_orderkey as pull_request_id, cast(sum(l_quantity) * 4 as bigint) as additions,
         cast(sum(l_linenumber) as bigint) as deletions, count(distinct l_partkey) as changed_files,
         count(*) as commits_count, cast(count(*) filter (where l_returnflag = 'R') as bigint) as review_comments_count,
         max(l_shipdate) as last_ship
  from lineitem group by l_orderkey),
a_prs as (
  select o_orderkey as pull_request_id, cast(o_orderkey % 1000 as int) as pr_number, o_orderpriority as title,
         case when o_orderstatus = 'O' then 'open' else 'closed' end as state, o_custkey as user_id,
         c_name as user_login, o_orderdate as created_at, r.full_name as canonical_repo_name, additions, deletions,
         changed_files, commits_count, review_comments_count,
         case when o_orderstatus in ('F', 'P') then last_ship end as closed_at,
         case when o_orderstatus = 'P' then last_ship end as merged_at,
         greatest(o_orderdate, last_ship) as updated_at,
         greatest(o_orderdate, last_ship) + interval 1 day as _bronze_ingest_ts,
         strftime(greatest(o_orderdate, last_ship), '%Y-%m') as _extraction_run_id,
         cast(c_nationkey as bigint) as repository_id
  from orders join customer on o_custkey = c_custkey
  join a_repos r on c_nationkey = r.repository_id
  left join a_pr_details d on d.pull_request_id = o_orderkey)"""

A_ISSUES = """
a_issues as (
  select event_id as issue_id, cast(event_id % 500 as int) as issue_number, event_type as title,
         case when event_type in ('purchase', 'signup') then 'closed' else 'open' end as state, user_id,
         c_name as user_login, ts as created_at,
         case when event_type in ('purchase', 'signup') then ts + to_hours(cast(floor(value) as bigint)) end as closed_at,
         case when event_type in ('purchase', 'signup') then ts + to_hours(cast(floor(value) as bigint)) else ts end
           as updated_at,
         cast(json_extract_string(props, '$.k') as int) as comments_count,
         event_type = 'error' as is_pull_request,
         cast(c_nationkey as bigint) as repository_id, r.full_name,
         (case when event_type in ('purchase', 'signup') then ts + to_hours(cast(floor(value) as bigint)) else ts end)
           + interval 1 day as _bronze_ingest_ts,
         strftime(ts, '%Y-%m-%d') as _extraction_run_id
  from events join customer on user_id = c_custkey join a_repos r on c_nationkey = r.repository_id)"""

A_RELEASES = """
a_releases as (
  select p_partkey as release_id, p_brand as tag_name, p_name as release_name, p_size < 5 as is_prerelease,
         p_partkey as author_id, c_name || '-' || p_type as author_login, timestamp '2024-01-01' as created_at,
         timestamp '2024-01-01' + to_days(p_size - 3) as published_at, p_partkey % 25 as repository_id,
         timestamp '2024-01-01' + to_days(p_size) as _bronze_ingest_ts, 'releases' as _extraction_run_id
  from part left join customer on p_partkey = c_custkey)"""

A_REPOSITORIES = """
a_repositories as (
  select c_custkey as repository_id, case when c_mktsegment <> 'MACHINERY' then c_name end as full_name,
         cast(floor(c_acctbal) as bigint) as stars, forks, forks - 5 as watchers, forks * 2 as open_issues,
         created_at, updated_at
  from customer left join (
    select o_custkey, count(*) as forks, min(o_orderdate) as created_at, max(o_orderdate) as updated_at
    from orders group by o_custkey) on o_custkey = c_custkey)"""


def failing(rules: list[tuple[str, str]]) -> str:
    """SQL list of failed rule names, from (name, condition) pairs."""
    each = ", ".join(f"case when ({cond}) then null else '{name}' end" for name, cond in rules)
    return f"list_filter([{each}], lambda x: x is not null)"


ISSUE_CHECKS = [
    ("issue_id_not_null", "issue_id is not null"),
    ("issue_number_positive", "issue_number > 0"),
    ("state_valid", "state in ('open', 'closed')"),
    ("created_at_not_null", "created_at is not null"),
    ("updated_at_not_null", "updated_at is not null"),
    ("created_before_updated", "created_at <= updated_at"),
    ("closed_at_after_created", "closed_at is null or closed_at >= created_at"),
    ("comments_count_non_negative", "comments_count >= 0"),
]
PR_CHECKS = [
    ("pr_id_not_null", "pull_request_id is not null"),
    ("pr_number_positive", "pr_number > 0"),
    ("state_valid", "state in ('open', 'closed')"),
    ("created_at_not_null", "created_at is not null"),
    ("updated_at_not_null", "updated_at is not null"),
    ("created_before_updated", "created_at <= updated_at"),
    ("merged_at_after_created", "merged_at is null or merged_at >= created_at"),
    ("closed_at_after_created", "closed_at is null or closed_at >= created_at"),
    ("merged_implies_closed", "merged_at is null or state = 'closed'"),
]
REPOSITORY_CHECKS = [
    ("repo_id_not_null", "repository_id is not null"),
    ("full_name_not_null", "full_name is not null"),
    ("stars_non_negative", "stars >= 0"),
    ("forks_non_negative", "forks >= 0"),
    ("watchers_non_negative", "watchers >= 0"),
    ("open_issues_non_negative", "open_issues >= 0"),
    ("created_at_not_null", "created_at is not null"),
    ("created_before_updated", "created_at <= updated_at"),
]
RELEASE_CHECKS = [
    ("release_id_not_null", "release_id is not null"),
    ("tag_name_not_null", "tag_name is not null"),
    ("created_at_not_null", "created_at is not null"),
    ("published_after_created", "published_at is null or published_at >= created_at"),
]

# the star schema over the analogues, in SQL
STAR = f"""
{A_REPOS},{A_PRS},{A_ISSUES},
v_prs as (select *, {failing(PR_CHECKS)} as failed from a_prs),
v_issues as (select *, {failing(ISSUE_CHECKS)} as failed from a_issues),
fact_issues as (
  select md5(cast(issue_id as varchar)) as issue_sk, md5(cast(repository_id as varchar)) as repository_sk,
         md5(cast(user_id as varchar)) as author_user_sk, issue_id, repository_id as repo_id,
         user_id as author_user_id, cast(strftime(created_at, '%Y%m%d') as int) as created_date_key,
         cast(strftime(closed_at, '%Y%m%d') as int) as closed_date_key, state,
         round((floor(epoch(closed_at)) - floor(epoch(created_at))) / 3600.0, 6) as time_to_close_hours,
         comments_count as comment_count, updated_at
  from v_issues where len(failed) = 0 and not is_pull_request),
fact_prs as (
  select md5(cast(pull_request_id as varchar)) as pull_request_sk, md5(cast(repository_id as varchar)) as repository_sk,
         md5(cast(user_id as varchar)) as author_user_sk, pull_request_id as pr_id, repository_id as repo_id,
         user_id as author_user_id, cast(strftime(created_at, '%Y%m%d') as int) as created_date_key,
         cast(strftime(merged_at, '%Y%m%d') as int) as merged_date_key,
         cast(strftime(closed_at, '%Y%m%d') as int) as closed_date_key, state,
         round((floor(epoch(merged_at)) - floor(epoch(created_at))) / 3600.0, 6) as time_to_merge_hours,
         round((floor(epoch(closed_at)) - floor(epoch(created_at))) / 3600.0, 6) as time_to_close_hours,
         review_comments_count as comment_count, additions, deletions, changed_files, commits_count, updated_at
  from v_prs where len(failed) = 0)"""
