"""A small landed data set: three repositories, three days, every special case of the record types."""

from __future__ import annotations

import json
import os

DAYS = ("2024-03-01", "2024-03-02", "2024-03-03")
REPOS = {1: "octo/alpha", 2: "octo/beta", 3: "renamed/gamma"}


def repository(rid, stars, pushed, description="text", created="2020-01-01T00:00:00Z", name=None):
    owner, repo = (name or REPOS[rid]).split("/")
    return {
        "id": rid, "full_name": f"{owner}/{repo}", "owner": {"login": owner}, "name": repo,
        "description": description, "language": "Python", "stargazers_count": stars, "forks_count": 1,
        "watchers_count": 1, "open_issues_count": 2, "default_branch": "main", "fork": False, "archived": False,
        "created_at": created, "updated_at": "2024-02-01T00:00:00Z", "pushed_at": pushed, "size": 10,
        "topics": ["a", "b"], "license": {"spdx_id": "MIT"},
    }


def issue(iid, repo, created, updated, state="open", closed=None, number=None, user=7, login="ada", comments=1, pr=False):
    row = {
        "id": iid, "number": iid if number is None else number, "title": f"t{iid}", "state": state,
        "user": {"id": user, "login": login} if user else None, "created_at": created, "updated_at": updated,
        "closed_at": closed, "comments": comments, "repository_url": f"https://api.github.com/repos/{REPOS[repo]}",
        "labels": [{"name": "bug"}],
    }
    return {**row, "pull_request": {"url": "u", "n": 1}} if pr else row


def pull(pid, repo, created, updated, state="open", closed=None, merged=None, user=8, login="bob"):
    return {
        "id": pid, "number": pid, "title": f"p{pid}", "state": state, "user": {"id": user, "login": login},
        "created_at": created, "updated_at": updated, "closed_at": closed, "merged_at": merged,
        "merge_commit_sha": "s", "draft": False, "head": {"ref": "f"},
        "base": {"ref": "main", "repo": {"full_name": REPOS[repo]}},
    }


def detail(pid, adds, dels):
    return {
        "id": pid, "number": pid, "additions": adds, "deletions": dels, "changed_files": 2, "commits": 3,
        "review_comments": 4,
    }


def release(rid, created, published, tag="v1", author=7, login="ada"):
    return {
        "id": rid, "tag_name": tag, "name": "r", "draft": False, "prerelease": False,
        "author": {"id": author, "login": login}, "created_at": created, "published_at": published,
        "target_commitish": "main",
    }


def day_one():
    return {
        "repositories": [(REPOS[r], repository(r, 10, "2024-02-01T00:00:00Z", None if r == 2 else "text")) for r in REPOS],
        "issues": [
            ("octo/alpha", issue(100, 1, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")),
            # the same issue twice in one load: the newer one wins
            ("octo/alpha", issue(101, 1, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")),
            ("octo/alpha", issue(101, 1, "2024-01-01T00:00:00Z", "2024-01-03T00:00:00Z", "closed", "2024-01-03T00:00:00Z")),
            ("octo/alpha", issue(102, 1, "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z", pr=True)),
            # closed before created; no number; negative comments
            ("octo/beta", issue(103, 2, "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z", "closed", "2024-01-01T00:00:00Z")),
            ("octo/beta", issue(104, 2, "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z", comments=-1)),
            ("octo/beta", {**issue(105, 2, "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z"), "number": None}),
            ("octo/beta", issue(106, 2, "soon", "2024-01-06T00:00:00Z")),
            # clean today, broken tomorrow
            ("octo/beta", issue(107, 2, "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z")),
            # the old name in the envelope, the new one in the record
            ("old/gamma", issue(108, 3, "2024-01-07T00:00:00Z", "2024-01-08T00:00:00Z", user=None)),
            ("octo/alpha", "{ broken"),
            ("octo/alpha", "also broken"),
        ],
        "pull_requests": [
            ("octo/alpha", pull(200, 1, "2023-06-01T00:00:00Z", "2024-01-02T00:00:00Z", "closed", "2024-01-02T00:00:00Z", "2024-01-02T00:00:00Z")),
            ("octo/beta", pull(201, 2, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")),
            # merged but open
            ("octo/beta", pull(202, 2, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", merged="2024-01-02T00:00:00Z")),
        ],
        "pr_details": [("octo/alpha", detail(200, 90, 20)), ("octo/alpha", "not a detail")],
        "releases": [
            ("octo/alpha", release(300, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")),
            ("octo/alpha", release(301, "2024-01-01T00:00:00Z", "2023-01-02T00:00:00Z")),
            ("octo/alpha", "{ no release"),
        ],
        "languages": [("octo/alpha", {"Python": 5, "C++": 0}), ("octo/beta", {}), ("who/knows", {"Go": 1})],
    }


def day_two():
    """Changes: an issue closes, one breaks, stars move on one repository, details arrive late; nothing released."""
    return {
        "repositories": [
            (REPOS[1], repository(1, 11, "2024-03-01T00:00:00Z")),
            (REPOS[2], repository(2, 10, "2024-03-01T00:00:00Z", None)),
            (REPOS[3], repository(3, 10, "2024-03-01T00:00:00Z")),
        ],
        "issues": [
            ("octo/alpha", issue(100, 1, "2024-01-01T00:00:00Z", "2024-03-01T12:00:00Z", "closed", "2024-03-01T12:00:00Z", login="ada2")),
            ("octo/beta", issue(107, 2, "2024-01-05T00:00:00Z", "2024-03-01T00:00:00Z", comments=-5)),
            # an older copy of a known issue loses
            ("octo/alpha", issue(101, 1, "2024-01-01T00:00:00Z", "2024-01-02T12:00:00Z")),
        ],
        "pull_requests": [],
        "pr_details": [("octo/beta", detail(201, 700, 0))],
        "languages": [("octo/alpha", {"Python": 6})],
    }


def day_three():
    """A description appears, and an old issue of an already followed repository is backfilled."""
    return {
        "repositories": [
            (REPOS[1], repository(1, 11, "2024-03-02T00:00:00Z")),
            (REPOS[2], repository(2, 10, "2024-03-02T00:00:00Z", "now described")),
            (REPOS[3], repository(3, 10, "2024-03-02T00:00:00Z")),
        ],
        "issues": [("renamed/gamma", issue(109, 3, "2022-01-01T00:00:00Z", "2022-01-02T00:00:00Z", user=9, login="cy"))],
        "pull_requests": [
            ("octo/beta", pull(201, 2, "2024-01-01T00:00:00Z", "2024-03-02T00:00:00Z", "closed", "2024-03-02T00:00:00Z", "2024-03-02T00:00:00Z")),
        ],
        "languages": [("octo/alpha", {"Python": 7})],
    }


def land(root: str, day: str, content: dict) -> None:
    """Write a day's lines as the landing zone holds them."""
    for resource, lines in content.items():
        for i, (repo, record) in enumerate(lines):
            folder = f"{root}/{resource}/ingestion_date={day}/{repo.replace('/', '_')}"
            os.makedirs(folder, exist_ok=True)
            lineage = {
                "extraction_run_id": f"run-{day}", "ingestion_timestamp": f"{day}T01:00:00+00:00",
                "ingestion_date": day, "source_endpoint": f"/{resource}", "http_status": 200,
                "api_rate_limit_remaining": None, "record_count": 1, "payload_checksum": "c",
                "source_s3_uri": folder, "repo_full_name": repo,
            }
            line = record if isinstance(record, str) else json.dumps({"data": record, "lineage": lineage})
            with open(f"{folder}/part_{i:03d}.json", "w") as f:
                f.write(line + "\n")
