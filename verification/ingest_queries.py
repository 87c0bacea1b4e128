"""Landing, bronze, staging and increment operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.payloads import canonical_json, explode_map, flatten_json, parsed_timestamp, payload_checksum
from strata.operators import incremental
from strata.plans import staging
from strata.session import scratch_dir
from strata.sources import bronze, raw, tables, volumes
from verification.analogues import A_ISSUES, A_PRS, A_RELEASES, A_REPOS, A_REPOSITORIES, URL_PREFIX, Tables
from verification.registry import query

NOW = "2024-02-01 00:00:00"
EVENT_FIELDS = ["event_id", "user_id", "event_type", "props", "seen_at", "amount"]


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def enveloped_events(t: Tables) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    # moments and numbers as text: JSON writers differ in how they print them
    events = t.events.withColumns(
        {
            "seen_at": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "amount": F.col("value").cast("decimal(20, 6)").cast("string"),
        }
    )
    return raw.wrap_envelope(
        events,
        run_id="run-1",
        endpoint="/events",
        ingestion_date=day,
        repo=F.concat(F.lit("events/"), F.col("event_type")),
        uri=F.concat(F.lit("raw/events/"), day),
        as_of=now(),
        payload=EVENT_FIELDS,
    )


EVENT_PARTS = {
    "event_id": "event_id",
    "user_id": "user_id",
    "event_type": "event_type",
    "props": "props",
    "seen_at": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
    "amount": "cast(cast(value as decimal(20, 6)) as varchar)",
}
EVENT_BODY = "{" + ", ".join(f"'{k}': {v}" for k, v in EVENT_PARTS.items()) + "}"
EVENT_JSON = f"to_json({EVENT_BODY})"
EVENT_SHA = "sha256(cast(to_json({" + ", ".join(f"'{k}': {v}" for k, v in sorted(EVENT_PARTS.items())) + "}) as varchar))"


@query(f"""
select cast(to_json({{'data': {EVENT_BODY},
         'lineage': {{'extraction_run_id': 'run-1', 'ingestion_timestamp': '2024-02-01T00:00:00.000000+00:00',
           'ingestion_date': strftime(ts, '%Y-%m-%d'), 'source_endpoint': '/events', 'http_status': 200,
           'api_rate_limit_remaining': null, 'record_count': 1, 'payload_checksum': {EVENT_SHA},
           'source_s3_uri': 'raw/events/' || strftime(ts, '%Y-%m-%d'),
           'repo_full_name': 'events/' || event_type}}}}) as varchar) as value,
       strftime(ts, '%Y-%m-%d') as ingestion_date, 'events_' || event_type as repo_slug
from events""")
def envelope_build(t: Tables) -> DataFrame:
    return enveloped_events(t)


@query(f"""
select cast({EVENT_JSON} as varchar) as data, '2024-02-01 00:00:00' as ingested_at,
       'raw/events/' || strftime(ts, '%Y-%m-%d') as _source_file, '/events' as _source_endpoint,
       'run-1' as _extraction_run_id, {EVENT_SHA} as _payload_checksum, 'events/' || event_type as _repo_full_name,
       strftime(ts, '%Y-%m-%d') as _ingestion_date
from events""")
def bronze_parse(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "raw")
    raw.write_raw(enveloped_events(t), path)
    parsed = bronze.parse_bronze(bronze.scan_raw(t.spark, path), now())
    return parsed.select(
        "data",
        F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
        "_source_file",
        "_source_endpoint",
        "_extraction_run_id",
        "_payload_checksum",
        "_repo_full_name",
        "_ingestion_date",
    )


@query("""
select 'issues' as resource, count(*) as n_rows, true as has_bytes, 'OK' as status from events union all
select 'pull_requests', count(*), true, 'OK' from orders union all
select 'releases', count(*), true, 'OK' from part union all
select 'repositories', 0, false, 'SKIPPED' union all select 'languages', 0, false, 'SKIPPED' union all
select 'pr_details', 0, false, 'SKIPPED'""")
def bronze_load_summary(t: Tables) -> DataFrame:
    """Three resources with lines, one whose folder is there but empty, two without a folder."""
    root = scratch_dir(t.spark, "landing")
    landed = {"issues": (t.events, "event_type"), "pull_requests": (t.orders, "o_orderpriority"), "releases": (t.part, "p_type")}
    for resource, (df, repo) in landed.items():
        lines = raw.wrap_envelope(df, "run-1", resource, "2024-02-01", F.col(repo), resource, now(), gather=True)
        raw.write_raw(lines, f"{root}/raw/{resource}", gathered=True)
    t.events.filter("false").select("event_type").write.text(f"{root}/raw/languages/ingestion_date=2024-02-01")
    loaded = bronze.load_all(t.spark, f"{root}/raw", f"{root}/bronze", "2024-02-01", now())
    return loaded.select("resource", "n_rows", (F.col("n_bytes") > 0).alias("has_bytes"), "status")


@query("""
select case when day(ts) % 2 = 1 then '2024-02-01' else '2024-02-02' end as ingestion_date, count(*) as n_rows
from events group by 1""")
def partition_replace_stray(t: Tables) -> DataFrame:
    """Two loads whose lines name many dates, the first one's among them: each load keeps to its own partition."""
    root = scratch_dir(t.spark, "stray")
    odd = F.dayofmonth("ts") % 2 == 1
    for date, some in (("2024-02-01", odd), ("2024-02-02", ~odd)):
        named = F.when(F.col("event_type") == "error", "2024-02-01").otherwise(F.date_format("ts", "yyyy-MM-dd"))
        lines = raw.wrap_envelope(
            t.events.filter(some), "run-1", "/events", named, F.col("event_type"), "raw", now(), payload=["event_id"]
        )
        lines.select("value").write.text(f"{root}/raw/{date}")
        bronze.load_resource(t.spark, f"{root}/raw/{date}", f"{root}/bronze", date, now())
    held = bronze.read_bronze(t.spark, f"{root}/bronze")
    return held.groupBy(F.col("_ingestion_date").alias("ingestion_date")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
select strftime(ts, '%Y-%m-%d') as ingestion_date,
       case when day(ts) % 2 = 0 then 'second' else 'first' end as load, count(*) as n_rows
from events where day(ts) % 2 = 1 or event_type <> 'error' group by all""")
def partition_replace(t: Tables) -> DataFrame:
    """All dates loaded, then the even ones loaded again with fewer rows: the rerun replaces them."""
    path = scratch_dir(t.spark, "replace")
    dated = t.events.withColumn("ingestion_date", F.date_format("ts", "yyyy-MM-dd"))
    bronze.replace_partitions(dated.withColumn("load", F.lit("first")), path, ["ingestion_date"])
    again = dated.filter("day(ts) % 2 = 0 and event_type <> 'error'").withColumn("load", F.lit("second"))
    bronze.replace_partitions(again, path, ["ingestion_date"])
    after = t.spark.read.parquet(path)
    return after.groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date"), "load").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("""
select event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') as ingestion_date from events
where strftime(ts, '%Y-%m-%d') = (select max(strftime(ts, '%Y-%m-%d')) from events)""")
def latest_partition(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "dated")
    dated = t.events.withColumn("ingestion_date", F.date_format("ts", "yyyy-MM-dd"))
    bronze.replace_partitions(dated, path, ["ingestion_date"])
    newest = bronze.latest_partition(t.spark.read.parquet(path), "ingestion_date")
    return newest.select("event_id", "user_id", "event_type", F.col("ingestion_date").cast("string"))


@query("""
select strftime(ts, '%Y-%m-%d') as ingestion_date, 'events_' || event_type as repo_slug, count(*) as n_lines,
       cast(ceil(count(*) / 20.0) as bigint) as min_parts, true as parts_within_limit
from events group by all""")
def raw_write_roundtrip(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "parts")
    raw.write_raw(enveloped_events(t), path, max_records=20)
    folders = raw.part_lines(t.spark, path).groupBy("ingestion_date", "repo_slug").agg(
        F.sum("n").alias("n_lines"), F.max("n").alias("largest"), F.count(F.lit(1)).alias("parts")
    )
    least = F.ceil(F.col("n_lines") / 20)
    return folders.select(
        F.col("ingestion_date").cast("string").alias("ingestion_date"),
        "repo_slug",
        "n_lines",
        least.alias("min_parts"),
        ((F.col("largest") <= 20) & (F.col("parts") >= least)).alias("parts_within_limit"),
    )


def issue_payloads(t: Tables) -> DataFrame:
    """Issues as API text; every 97th line is cut off and every 89th date is not a date."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    text = F.to_json(
        F.struct(
            F.col("issue_id").alias("id"),
            F.col("issue_number").alias("number"),
            "title",
            "state",
            F.struct(F.col("user_id").alias("id"), F.col("user_login").alias("login")).alias("user"),
            F.when(F.col("issue_id") % 89 == 0, "soon")
            .otherwise(F.date_format("created_at", iso))
            .alias("created_at"),
            F.date_format("updated_at", iso).alias("updated_at"),
            F.date_format("closed_at", iso).alias("closed_at"),
            F.col("comments_count").alias("comments"),
            "repository_url",
            F.when(F.col("is_pull_request"), F.struct(F.col("repository_url").alias("url"))).alias("pull_request"),
            F.array(F.struct(F.col("title").alias("name"))).alias("labels"),
        )
    )
    cut = F.substring(text, 1, 20)
    return t.a_issues().select("issue_id", F.when(F.col("issue_id") % 97 == 0, cut).otherwise(text).alias("data"))


@query(f"""
with {A_REPOS},{A_ISSUES}, p as (select *, issue_id % 97 <> 0 as good from a_issues)
select issue_id as line, case when good then issue_id end as issue_id, case when good then issue_number end as issue_number,
       case when good then state end as state, case when good then user_id end as user_id,
       case when good then user_login end as user_login, case when good then comments_count end as comments_count,
       case when good and issue_id % 89 <> 0 then strftime(created_at, '%Y-%m-%d %H:%M:%S') end as created_at,
       case when good then strftime(updated_at, '%Y-%m-%d %H:%M:%S') end as updated_at,
       case when good then strftime(closed_at, '%Y-%m-%d %H:%M:%S') end as closed_at,
       case when good then title end as title, case when good then '{URL_PREFIX}' || full_name end as repository_url,
       coalesce(good and is_pull_request, false) as is_pull_request, case when good then title end as first_label
from p""")
def json_flatten(t: Tables) -> DataFrame:
    fields = {
        **{k: v for k, v in staging.ISSUE_FIELDS.items() if k != "labels"},
        **{c: F.date_format(parsed_timestamp(c), "yyyy-MM-dd HH:mm:ss") for c in ("created_at", "updated_at", "closed_at")},
        "is_pull_request": F.col("payload.pull_request").isNotNull(),
        "first_label": F.get("payload.labels", F.lit(0)).getField("name"),
    }
    return flatten_json(issue_payloads(t), "data", schemas.ISSUE, fields, [F.col("issue_id").alias("line")])


ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def landed(df: DataFrame, payload, repo) -> DataFrame:
    """Bronze rows with ``payload`` as their text."""
    return df.select(
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("data"),
        repo.alias("_repo_full_name"),
        F.lit(NOW).cast("timestamp").alias("_bronze_ingest_ts"),
        F.lit(NOW).cast("timestamp").alias("_ingestion_timestamp"),
        F.lit("run-1").alias("_extraction_run_id"),
        F.lit("2024-02-01").alias("_ingestion_date"),
    )


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns, moments as text."""
    kinds = dict(df.dtypes)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select(*[text(c) if kinds[c].startswith("timestamp") else F.col(c) for c in columns])


@query(f"""
with {A_REPOSITORIES}
select repository_id, full_name, 'owner' as owner_login, 'r' || repository_id as repo_name,
       case when repository_id % 3 <> 0 then 'about' end as description, 'lang' as primary_language, stars, forks, watchers,
       open_issues, 'main' as default_branch, repository_id % 2 = 0 as is_fork, false as is_archived,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at, strftime(updated_at, '%Y-%m-%d %H:%M:%S') as updated_at,
       strftime(updated_at, '%Y-%m-%d %H:%M:%S') as pushed_at, repository_id * 2 as repo_size_kb, 'a,b' as topics,
       case when repository_id % 5 <> 0 then 'MIT' end as license
from a_repositories""")
def flatten_repositories(t: Tables) -> DataFrame:
    rid, lit = F.col("repository_id"), F.lit
    payload = [
        rid.alias("id"), F.struct(lit("owner").alias("login")).alias("owner"), F.concat(lit("r"), rid).alias("name"),
        F.when(rid % 3 != 0, "about").alias("description"), lit("lang").alias("language"),
        F.col("stars").alias("stargazers_count"), F.col("forks").alias("forks_count"),
        F.col("watchers").alias("watchers_count"), F.col("open_issues").alias("open_issues_count"),
        lit("main").alias("default_branch"), (rid % 2 == 0).alias("fork"), lit(False).alias("archived"),
        F.date_format("created_at", ISO).alias("created_at"), F.date_format("updated_at", ISO).alias("updated_at"),
        F.date_format("updated_at", ISO).alias("pushed_at"), (rid * 2).alias("size"), F.array(lit("a"), lit("b")).alias("topics"),
        F.when(rid % 5 != 0, F.struct(lit("MIT").alias("spdx_id"))).alias("license"),
    ]
    staged = staging.stage_repositories(landed(t.a_repositories(), payload, F.col("full_name")))
    staged = staged.withColumn("topics", F.array_join("topics", ","))
    return shown(staged, "repository_id", "full_name", *[c for c in staging.REPOSITORY_FIELDS if c != "repository_id"], "created_at", "updated_at", "pushed_at")


@query(f"""
with {A_REPOS},{A_PRS}
select pull_request_id, pr_number, title, state, user_id, user_login, 'sha' || pull_request_id as merge_commit_sha,
       pull_request_id % 7 = 0 as is_draft, 'topic' as head_branch, 'main' as base_branch, canonical_repo_name,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at, strftime(updated_at, '%Y-%m-%d %H:%M:%S') as updated_at,
       strftime(closed_at, '%Y-%m-%d %H:%M:%S') as closed_at, strftime(merged_at, '%Y-%m-%d %H:%M:%S') as merged_at
from a_prs""")
def flatten_pull_requests(t: Tables) -> DataFrame:
    """With the base repository's name, three levels down."""
    key, lit = F.col("pull_request_id"), F.lit
    base = F.struct(lit("main").alias("ref"), F.struct(F.col("canonical_repo_name").alias("full_name")).alias("repo"))
    days = ("created_at", "updated_at", "closed_at", "merged_at")
    payload = [
        key.alias("id"), F.col("pr_number").alias("number"), "title", "state",
        F.struct(F.col("user_id").alias("id"), F.col("user_login").alias("login")).alias("user"),
        F.concat(lit("sha"), key).alias("merge_commit_sha"), (key % 7 == 0).alias("draft"),
        F.struct(lit("topic").alias("ref")).alias("head"), base.alias("base"),
        *[F.date_format(c, ISO).alias(c) for c in days],
    ]
    typed = staging.type_pull_requests(landed(t.a_prs(), payload, F.col("canonical_repo_name")))
    return shown(typed, *staging.PULL_REQUEST_FIELDS, *days)


@query(f"""
with {A_REPOS},{A_PRS}
select pull_request_id, cast(pull_request_id % 1000 as int) as pr_number, additions, deletions, commits_count, changed_files,
       review_comments_count from a_pr_details""")
def flatten_pr_details(t: Tables) -> DataFrame:
    key = F.col("pull_request_id")
    names = {"commits": "commits_count", "review_comments": "review_comments_count"}
    measures = ("additions", "deletions", "changed_files", "commits", "review_comments")
    payload = [key.alias("id"), (key % 1000).alias("number"), *[F.col(names.get(c, c)).alias(c) for c in measures]]
    return shown(staging.stage_pr_details(landed(t.a_pr_details(), payload, F.lit("any"))), *staging.PR_DETAIL_FIELDS)


@query(f"""
with {A_RELEASES}
select release_id, tag_name, release_name, release_id % 9 = 0 as is_draft, is_prerelease, author_id, author_login,
       'main' as target_commitish, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at,
       strftime(published_at, '%Y-%m-%d %H:%M:%S') as published_at from a_releases""")
def flatten_releases(t: Tables) -> DataFrame:
    key = F.col("release_id")
    payload = [
        key.alias("id"), "tag_name", F.col("release_name").alias("name"), (key % 9 == 0).alias("draft"),
        F.col("is_prerelease").alias("prerelease"),
        F.struct(F.col("author_id").alias("id"), F.col("author_login").alias("login")).alias("author"),
        F.lit("main").alias("target_commitish"),
        *[F.date_format(c, ISO).alias(c) for c in ("created_at", "published_at")],
    ]
    typed = staging.stage_releases(landed(t.a_releases(), payload, F.lit("any")))
    return shown(typed, *staging.RELEASE_FIELDS, "created_at", "published_at")


@query(f"""
with {A_REPOS},{A_PRS}
select pull_request_id as id, cast(pull_request_id % 1000 as int) as number, additions, deletions, changed_files,
       commits_count as commits, review_comments_count as review_comments
from a_pr_details where pull_request_id % 50 <> 7""")
def pr_detail_normalize(t: Tables) -> DataFrame:
    node = F.to_json(
        F.struct(
            F.col("pull_request_id").alias("databaseId"),
            (F.col("pull_request_id") % 1000).alias("number"),
            "additions",
            "deletions",
            F.col("changed_files").alias("changedFiles"),
            F.struct(F.col("commits_count").alias("totalCount")).alias("commits"),
            F.struct(F.col("review_comments_count").alias("totalCount")).alias("reviewThreads"),
        )
    )
    nodes = t.a_pr_details().select(F.when(F.col("pull_request_id") % 50 == 7, "null").otherwise(node).alias("node"))
    return raw.normalize_pr_details(nodes, "node")


@query("""
select doc_id, sha256(cast(to_json({'doc_id': doc_id, 'lang': lang, 'n_chars': n_chars, 'source': source, 'text': text})
       as varchar)) as checksum from documents""")
def payload_checksum_documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", payload_checksum(["doc_id", "text", "lang", "source", "n_chars"]).alias("checksum"))


@query("""
with c as (select sha256(cast(to_json({'lang': lang, 'text': text}) as varchar)) as checksum from documents)
select checksum, count(*) as n_rows from c group by checksum having count(*) > 1""")
def check_duplicate_payloads(t: Tables) -> DataFrame:
    from strata.operators.checks import check_unique

    return check_unique(t.documents.select(F.sha2(canonical_json(["text", "lang"]), 256).alias("checksum")), ["checksum"])


@query("""
with m as (select user_id as u, max(ts) - interval 5 day as boundary from events where user_id % 3 <> 0 group by user_id)
select event_id, user_id, event_type from events left join m on user_id = u
where u is null or ts >= boundary - interval 10 minute""")
def since_filter(t: Tables) -> DataFrame:
    marks = t.events.filter("user_id % 3 <> 0").groupBy("user_id")
    marks = marks.agg((F.max("ts") - F.expr("interval 5 days")).alias("boundary"))
    return incremental.since_filter(t.events, marks, "user_id", "ts").select("event_id", "user_id", "event_type")


@query("""
with old as (select user_id as repo, min(ts) as boundary from events where user_id % 4 <> 0 group by user_id),
     new as (select user_id as repo, max(ts) as boundary from events where event_type = 'error' group by user_id)
select coalesce(n.repo, o.repo) as repo, coalesce(n.boundary, o.boundary) as boundary
from old o full join new n on o.repo = n.repo""")
def watermark_advance(t: Tables) -> DataFrame:
    repo = F.col("user_id").alias("repo")
    old = t.events.filter("user_id % 4 <> 0").groupBy(repo).agg(F.min("ts").alias("boundary"))
    new = t.events.filter("event_type = 'error'").groupBy(repo).agg(F.max("ts").alias("boundary"))
    return incremental.advance_watermarks(old, new)


@query(f"""
with {A_REPOS},{A_ISSUES},
l as (select full_name as repo, 'issues' as resource, count(*) as loaded from a_issues group by all),
e as (select full_name as repo, 'issues' as resource, count(*) * 7 as expected
      from customer join a_repos on c_nationkey = repository_id group by all)
select coalesce(l.repo, e.repo) as repo, coalesce(l.resource, e.resource) as resource,
       coalesce(loaded, 0) as loaded, expected, coalesce(loaded, 0) / expected as loaded_share
from l full join e on l.repo = e.repo and l.resource = e.resource""")
def load_vs_estimate(t: Tables) -> DataFrame:
    issues = t.a_issues().select(
        F.replace("repository_url", F.lit(URL_PREFIX), F.lit("")).alias("repo"), F.lit("issues").alias("resource")
    )
    customers = t.customer.join(t.a_repos(), F.col("c_nationkey") == F.col("repository_id"))
    expected = customers.groupBy(F.col("full_name").alias("repo"), F.lit("issues").alias("resource")).agg(
        (F.count(F.lit(1)) * 7).alias("expected")
    )
    return volumes.load_vs_estimate(issues, expected)


def language_maps(t: Tables) -> DataFrame:
    """Per user the JSON object of event type -> count; users of every 10th id have an empty object, every 10th + 1
    a broken one."""
    kinds = ("click", "error", "purchase", "signup", "view")
    counts = [F.nullif(F.count_if(F.col("event_type") == k), F.lit(0)).alias(k) for k in kinds]
    per_user = t.events.groupBy("user_id").agg(F.to_json(F.struct(*counts)).alias("data"))
    data = F.when(F.col("user_id") % 10 == 0, "{}").when(F.col("user_id") % 10 == 1, "{oops").otherwise(F.col("data"))
    return per_user.withColumn("data", data)


@query("""
select user_id, event_type as language, count(*) as bytes from events where user_id % 10 not in (0, 1)
group by user_id, event_type""")
def languages_unpivot(t: Tables) -> DataFrame:
    return explode_map(language_maps(t), "data", "language", "bytes")


# -- increments -----------------------------------------------------------------------------------------------

CUT = "1997-01-01 00:00:00"


@query(f"""
with {A_REPOS},{A_PRS}, done as (select max(_bronze_ingest_ts) as hwm from a_prs where _bronze_ingest_ts < '{CUT}')
select pull_request_id, state, _bronze_ingest_ts from a_prs, done where _bronze_ingest_ts > hwm""")
def hwm_filter(t: Tables) -> DataFrame:
    prs = t.a_prs()
    done = prs.filter(F.col("_bronze_ingest_ts") < F.lit(CUT).cast("timestamp_ntz"))
    fresh = incremental.hwm_filter(prs, done, "_bronze_ingest_ts")
    return fresh.select("pull_request_id", "state", "_bronze_ingest_ts")


@query(f"""
with {A_REPOS},{A_PRS}, done as (select max(updated_at) - interval 3 day as low from a_prs where created_at < '{CUT}')
select pull_request_id, state, updated_at from a_prs, done where updated_at >= low""")
def lookback_filter(t: Tables) -> DataFrame:
    prs = t.a_prs()
    done = prs.filter(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz"))
    return incremental.lookback_filter(prs, done, "updated_at", 3).select("pull_request_id", "state", "updated_at")


@query(f"""
with {A_REPOS},{A_PRS}, done as (
  select user_id as u, max(updated_at) - interval 3 day as low from a_prs where created_at < '{CUT}' group by user_id)
select pull_request_id, user_id, updated_at from a_prs left join done on user_id = u
where u is null or updated_at >= low""")
def lookback_filter_scoped(t: Tables) -> DataFrame:
    prs = t.a_prs()
    done = prs.filter(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz"))
    kept = incremental.lookback_filter(prs, done, "updated_at", 3, scope="user_id")
    return kept.select("pull_request_id", "user_id", "updated_at")


@query(f"""
with latest as (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_extendedprice desc, l_shipdate desc, l_partkey desc) as rn from lineitem)
select l_orderkey, l_linenumber, l_extendedprice, l_shipdate from latest
where rn = 1 and l_shipdate > (select max(l_shipdate) from lineitem where l_shipdate < '{CUT}')""")
def dedup_since(t: Tables) -> DataFrame:
    done = t.lineitem.filter(F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz"))
    order = ["l_extendedprice", "l_shipdate", "l_partkey"]
    newest = incremental.dedup_since(t.lineitem, done, ["l_orderkey", "l_linenumber"], order, "l_shipdate")
    return newest.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")


@query(f"""
with {A_REPOS},{A_PRS}
select pull_request_id, case when created_at >= '{CUT}' then state else 'open' end as state,
       case when created_at >= '{CUT}' then updated_at else created_at end as updated_at
from a_prs""")
def merge_upsert(t: Tables) -> DataFrame:
    """A table of all pull requests as opened, upserted with the final state of the newer ones."""
    path, spark = scratch_dir(t.spark, "merge"), t.spark
    cut = F.lit(CUT).cast("timestamp_ntz")
    bucket = tables.hash_bucket(["pull_request_id"], 8)
    prs = t.a_prs()
    opened = prs.filter(F.col("created_at") < F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "pull_request_id", F.lit("open").alias("state"), F.col("created_at").alias("updated_at")
    )
    final = prs.filter(F.col("created_at") >= cut).select("pull_request_id", "state", "updated_at")
    tables.upsert_table(spark, path, opened, ["pull_request_id"], bucket)
    tables.upsert_table(spark, path, final, ["pull_request_id"], bucket)
    return tables.read_table(spark, path)


@query("""
with h as (select l_orderkey as k, max(l_shipdate) as ts from lineitem where l_linenumber % 2 = 0 group by 1),
     n as (select l_orderkey as k, max(l_shipdate) as ts from lineitem where l_linenumber % 2 = 1 group by 1)
select coalesce(h.k, n.k) as order_id,
       case when h.k is null or n.ts >= h.ts then 'update' else 'target' end as origin,
       case when h.k is null or n.ts >= h.ts then n.ts else h.ts end as updated_at
from h full join n on h.k = n.k""")
def merge_newest_wins(t: Tables) -> DataFrame:
    def side(parity: int, origin: str) -> DataFrame:
        rows = t.lineitem.filter(F.col("l_linenumber") % 2 == parity).groupBy(F.col("l_orderkey").alias("order_id"))
        return rows.agg(F.max("l_shipdate").alias("updated_at")).withColumn("origin", F.lit(origin))

    return incremental.merge_upsert(side(0, "target"), side(1, "update"), ["order_id"], newer_by=["updated_at"])
