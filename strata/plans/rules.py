"""Quality rules of the five record types. The rule names are fixed values: they appear in the output."""

from __future__ import annotations

from strata.operators.quality import Rule


def present(col: str, name: str | None = None) -> Rule:
    return Rule(name or f"{col}_not_null", f"{col} is not null")


def positive(col: str, name: str | None = None) -> Rule:
    return Rule(name or f"{col}_positive", f"{col} > 0")


def not_negative(col: str) -> Rule:
    return Rule(f"{col}_non_negative", f"{col} >= 0")


def not_before(name: str, earlier: str, later: str, optional: bool = True) -> Rule:
    return Rule(name, f"{later} is null or {later} >= {earlier}" if optional else f"{earlier} <= {later}")


STATE_VALID = Rule("state_valid", "state in ('open', 'closed')")
LIFE = [
    present("created_at"),
    present("updated_at"),
    not_before("created_before_updated", "created_at", "updated_at", optional=False),
]

ISSUE_RULES = [
    present("issue_id"),
    positive("issue_number"),
    STATE_VALID,
    *LIFE,
    not_before("closed_at_after_created", "created_at", "closed_at"),
    not_negative("comments_count"),
]

PULL_REQUEST_RULES = [
    present("pull_request_id", "pr_id_not_null"),
    positive("pr_number"),
    STATE_VALID,
    *LIFE,
    not_before("merged_at_after_created", "created_at", "merged_at"),
    not_before("closed_at_after_created", "created_at", "closed_at"),
    Rule("merged_implies_closed", "merged_at is null or state = 'closed'"),
]

REPOSITORY_RULES = [
    present("repository_id", "repo_id_not_null"),
    present("full_name"),
    *[not_negative(c) for c in ("stars", "forks", "watchers", "open_issues")],
    present("created_at"),
    LIFE[2],
]

RELEASE_RULES = [
    present("release_id"),
    present("tag_name"),
    present("created_at"),
    not_before("published_after_created", "created_at", "published_at"),
]

LANGUAGE_RULES = [
    present("language"),
    positive("bytes"),
    present("repository_id", "repo_id_not_null"),
]
