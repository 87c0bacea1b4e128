"""Fixed formats: the landed envelope and the payload fields the jobs read.

These are values that must match the landed records: field names and types as the API delivers them.
"""

LINEAGE = (
    "extraction_run_id string, ingestion_timestamp string, ingestion_date string, source_endpoint string, "
    "http_status int, api_rate_limit_remaining int, record_count int, payload_checksum string, "
    "source_s3_uri string, repo_full_name string"
)

BRONZE = (
    "_bronze_ingest_ts timestamp, _source_file string, _raw_s3_uri string, _source_endpoint string, "
    "_ingestion_timestamp timestamp, _extraction_run_id string, _payload_checksum string, _repo_full_name string, "
    "data string, _ingestion_date string"
)

REPOSITORY = (
    "id bigint, full_name string, owner struct<login:string>, name string, description string, language string, "
    "stargazers_count bigint, forks_count bigint, watchers_count bigint, open_issues_count bigint, "
    "default_branch string, fork boolean, archived boolean, created_at string, updated_at string, "
    "pushed_at string, size bigint, topics array<string>, license struct<spdx_id:string>"
)

# pull_request is an object kept as text: only whether it is there matters
ISSUE = (
    "id bigint, number int, title string, state string, user struct<id:bigint,login:string>, created_at string, "
    "updated_at string, closed_at string, comments int, repository_url string, pull_request string, "
    "labels array<struct<name:string>>"
)

PULL_REQUEST = (
    "id bigint, number int, title string, state string, user struct<id:bigint,login:string>, created_at string, "
    "updated_at string, closed_at string, merged_at string, merge_commit_sha string, draft boolean, "
    "head struct<ref:string>, base struct<ref:string,repo:struct<full_name:string>>"
)

PR_DETAIL = (
    "id bigint, number int, additions bigint, deletions bigint, changed_files bigint, commits bigint, "
    "review_comments bigint"
)

PR_DETAIL_NODE = (
    "databaseId bigint, number int, additions bigint, deletions bigint, changedFiles bigint, "
    "commits struct<totalCount:bigint>, reviewThreads struct<totalCount:bigint>"
)

RELEASE = (
    "id bigint, tag_name string, name string, draft boolean, prerelease boolean, "
    "author struct<id:bigint,login:string>, created_at string, published_at string, target_commitish string"
)

REPOSITORY_URL_PREFIX = "https://api.github.com/repos/"

RESOURCES = ("repositories", "issues", "pull_requests", "releases", "languages", "pr_details")
