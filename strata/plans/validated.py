"""Typed rows with their repository resolved and their quality judged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import resolve_reference
from strata.operators.quality import evaluate_rules
from strata.plans import rules
from strata.schemas import REPOSITORY_URL_PREFIX


def owner_and_name() -> Column:
    return F.concat_ws("/", "owner_login", "repo_name")


def name_in_url(url: str) -> Column:
    return F.replace(F.col(url), F.lit(REPOSITORY_URL_PREFIX), F.lit(""))


def resolve_by_url(issues: DataFrame, repos: DataFrame) -> DataFrame:
    return resolve_reference(issues, repos, name_in_url("repository_url"), owner_and_name(), ["repository_id"])


def resolve_by_name(prs: DataFrame, repos: DataFrame) -> DataFrame:
    return resolve_reference(prs, repos, "canonical_repo_name", owner_and_name(), ["repository_id"])


def resolve_by_full_name(df: DataFrame, repos: DataFrame, col: str) -> DataFrame:
    return resolve_reference(df, repos, col, "full_name", ["repository_id"])


def validate_repositories(staged: DataFrame) -> DataFrame:
    return evaluate_rules(staged, rules.REPOSITORY_RULES)


def judge_issues(typed: DataFrame, repos: DataFrame) -> DataFrame:
    return evaluate_rules(resolve_by_url(typed, repos), rules.ISSUE_RULES)


def validate_issues(staged: DataFrame, repos: DataFrame) -> DataFrame:
    return judge_issues(staged, repos).drop("repo_full_name")


def validate_pull_requests(staged: DataFrame, repos: DataFrame) -> DataFrame:
    return evaluate_rules(resolve_by_name(staged, repos), rules.PULL_REQUEST_RULES)


def validate_releases(staged: DataFrame, repos: DataFrame) -> DataFrame:
    return evaluate_rules(resolve_by_full_name(staged, repos, "_repo_full_name"), rules.RELEASE_RULES)


def validate_languages(staged: DataFrame, repos: DataFrame) -> DataFrame:
    return evaluate_rules(resolve_by_full_name(staged, repos, "repo_full_name"), rules.LANGUAGE_RULES)
