"""Small column helpers shared by the plans. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(col: str | Column) -> Column:
    """md5 of the business key; null stays null."""
    return F.md5(_col(col).cast("string"))


def date_key(ts: str | Column) -> Column:
    """Calendar day as a yyyyMMdd integer (date arithmetic, no text formatting)."""
    ts = _col(ts)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def day_of_key(key: str | Column) -> Column:
    """Inverse of :func:`date_key`."""
    key = _col(key)
    return F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)


def month_of_key(key: str | Column) -> Column:
    """``yyyy-MM`` text of a yyyyMMdd key."""
    text = _col(key).cast("string")
    return F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2))


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end, as decimal hours."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / F.lit(Decimal("3600.0"))


def short_name(full_name: str | Column) -> Column:
    """Last path segment: ``owner/name`` -> ``name``."""
    return F.element_at(F.split(_col(full_name), "/"), -1)


def repo_slug(full_name: str | Column) -> Column:
    return F.translate(_col(full_name), "/", "_")


def ratio(part: str | Column, whole: str | Column) -> Column:
    """part / whole as double, null when whole is 0 or null."""
    return _col(part) / F.nullif(_col(whole), F.lit(0))


def contributor_label(user: str | Column, repo: str | Column) -> Column:
    return F.concat_ws(" · ", _col(user), short_name(repo))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
