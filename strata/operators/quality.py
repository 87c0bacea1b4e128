"""Rule-based quarantine."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILED = "dq_failed_rules"
FLAG = "is_quarantined"


@dataclass(frozen=True)
class Rule:
    """``expr`` is Spark SQL that is TRUE for a good row; FALSE and NULL both fail."""

    name: str
    expr: str


def evaluate_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the array of failed rule names and the quarantine flag. A map-only projection, no shuffle.

    The flag is a plain conjunction, so keeping the clean rows stays in generated code and stops at the first
    failure; names are collected only for rows that fail.
    """
    passes = reduce(Column.__and__, [F.coalesce(F.expr(r.expr), F.lit(False)) for r in rules])
    verdicts = [F.when(F.expr(r.expr), F.lit(None)).otherwise(F.lit(r.name)) for r in rules]
    names = F.when(passes, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*verdicts)))
    return df.select("*", names.alias(FAILED), (~passes).alias(FLAG))


def rules_digest(rules: Sequence[Rule]) -> str:
    """A short text that changes with any rule's name, condition or place."""
    return hashlib.sha256(json.dumps([(r.name, r.expr) for r in rules]).encode()).hexdigest()


def clean(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(FLAG)).drop(FAILED, FLAG)


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(FLAG)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean(df), quarantined(df)


def rule_summary(df: DataFrame) -> DataFrame:
    """Failures per rule. The count is combined before its shuffle, so only one row per rule and task moves."""
    return (
        df.select(F.explode(FAILED).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("failed_rows"))
    )
