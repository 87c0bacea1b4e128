"""KPIs kept by signed deltas: a changed fact row takes back what it counted before and adds what it counts now.

Four tables of counts follow the facts' change feeds: per (repository, kind, author), per (repository, month, kind, hours), per
(repository, user) and per (kind, day). Sums take deltas as they are; distinct authors are rows of the first table, medians come from
the second one, which holds how often each number of hours occurs. Two tables of measures (per repository, and per repository
and month) are computed anew only for the repositories and months that a run has changed, from their counts alone. So a day's
work follows the day's changes, and only the last step, which names repositories and fills the calendar, is as large as its result.

All tables are logged tables: a run that stops is finished by the next one, and no delta counts twice.

The series counts an event in its month. (The full computation cuts the calendar by days; the two differ only for events before
the first creation day in that same month, and for events more than a year ahead.)
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import day_of_key, month_of_key
from strata.plans import gold, kpis
from strata.session import written
from strata.sources.changes import CHANGE, ChangeLog, merge_logged, upsert_logged
from strata.sources.tables import BUCKET, read_or_none, read_table, touched_buckets

SUBBUCKETS = 4  # a repository is spread over so many buckets


class KpiState:
    """Counts and measures below one folder, following the facts at the given paths."""

    def __init__(self, spark: SparkSession, root: str, issues_path: str, prs_path: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.facts = {"issues": issues_path, "prs": prs_path}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame | None:
        return read_table(self.spark, self.path(name))

    def _home(self, repo: str | Column = "repo_id") -> Column:
        return F.pmod(F.xxhash64(repo), F.lit(self.buckets)).cast("int") * SUBBUCKETS

    def _bucket(self, keys: Sequence[str]) -> Column:
        return self._home() + F.pmod(F.xxhash64(*keys), F.lit(SUBBUCKETS)).cast("int")

    # -- counts -------------------------------------------------------------------------------------------------

    def refresh(self) -> None:
        """Bring counts and measures up to the facts' last writes."""
        self._add("authors", ["repo_id", "kind", "author_user_id"], ["n", "n_open"], _authors)
        self._add("months", ["repo_id", "month_year", "kind", "hours"], ["n_rows"], _months)
        self._add("users", ["repo_id", "user_id"], ["n_rows", *kpis.CONTRIBUTIONS], _users)
        self._add("days", ["kind", "day_key"], ["n_rows"], _days, F.lit(0))
        self._measure_repositories()
        self._measure_months()

    def _add(
        self,
        name: str,
        keys: list[str],
        sums: list[str],
        counted: Callable[[DataFrame, DataFrame], DataFrame],
        bucket: Column | None = None,
    ) -> None:
        """Add to a table of counts what the facts' changes since its last write come to."""
        path = self.path(name)
        known = ChangeLog(self.spark, path).marks()
        logs = {fact: ChangeLog(self.spark, at) for fact, at in self.facts.items()}
        newest = {fact: log.newest() for fact, log in logs.items()}
        if all(known.get(fact, 0) >= n for fact, n in newest.items()):
            return
        changed = {fact: log.since(known.get(fact, 0)) for fact, log in logs.items()}
        sides = []
        for side, sign in (("before", -1), ("after", 1)):
            rows = {fact: self._side(fact, df, side) for fact, df in changed.items()}
            if all(df is not None for df in rows.values()):
                counts = counted(rows["issues"], rows["prs"])
                sides.append(counts.select(*keys, *[(F.col(c) * sign).cast("long").alias(c) for c in sums]))
        if not sides:
            return
        deltas = reduce(DataFrame.unionByName, sides).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
        deltas = deltas.filter(reduce(Column.__or__, [F.col(c) != 0 for c in sums]))

        def merged(old: Column, new: Column) -> Column:
            total = {c: F.coalesce(old.getField(c), F.lit(0)) + new.getField(c) for c in sums}
            row = reduce(lambda r, c: r.withField(c, total[c]), sums, new)
            return F.when(total[sums[0]] != 0, row)  # the first one counts rows

        merge_logged(self.spark, path, deltas, keys, self._bucket(keys) if bucket is None else bucket, merged, newest)

    def _side(self, fact: str, changed: DataFrame | None, side: str) -> DataFrame | None:
        if changed is None:  # nothing new on this side: the other fact's rows still count
            table = read_or_none(self.spark, self.facts[fact])
            return None if table is None else table.limit(0)
        return changed.filter(F.col(CHANGE) == side)

    # -- measures -----------------------------------------------------------------------------------------------

    def _changed(self, name: str, sources: Sequence[str], keys: Sequence[str]) -> tuple[DataFrame | None, dict[str, int]]:
        """Keys whose counts have changed since ``name`` was measured, and the marks to leave."""
        known = ChangeLog(self.spark, self.path(name)).marks()
        logs = {s: ChangeLog(self.spark, self.path(s)) for s in sources}
        feeds = [log.since(known.get(s, 0)) for s, log in logs.items()]
        feeds = [f.select(*keys).dropna() for f in feeds if f is not None]
        marks = {s: log.newest() for s, log in logs.items()}
        changed = written(reduce(DataFrame.unionByName, feeds).distinct(), "changed") if feeds else None
        return (None if changed is None or changed.isEmpty() else changed), marks

    def _rows_of(self, name: str, repos: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Counts of some repositories (or their months); buckets that hold none of them are not opened."""
        homes = touched_buckets(repos.select(self._home().alias(BUCKET)))
        buckets = [home + k for home in homes for k in range(SUBBUCKETS)]
        table = read_or_none(self.spark, self.path(name)).filter(F.col(BUCKET).isin(buckets)).drop(BUCKET)
        return table.join(repos, list(keys), "left_semi")

    def _measure_repositories(self) -> None:
        repos, marks = self._changed("health", ["authors", "months"], ["repo_id"])
        if repos is None:
            return
        counts = kpis.health_counts(self._rows_of("authors", repos, ["repo_id"]))
        hours = self._rows_of("months", repos, ["repo_id"]).filter(F.col("hours").isNotNull())
        kind = F.when(F.col("kind") == "issues_closed", "issue").when(F.col("kind") == "prs_merged", "pr")
        hours = hours.groupBy("repo_id", kind.alias("kind"), "hours").agg(F.sum("n_rows").alias("n_rows"))
        measured = repos.join(counts, "repo_id", "left").join(kpis.health_medians(hours), "repo_id", "left")
        upsert_logged(self.spark, self.path("health"), measured, ["repo_id"], self._home(), marks=marks)

    def _measure_months(self) -> None:
        keys = ["repo_id", "month_year"]
        changed, marks = self._changed("series", ["months"], keys)
        if changed is None:
            return
        measured = changed.join(kpis.month_measures(self._rows_of("months", changed, keys)), keys, "left")
        upsert_logged(self.spark, self.path("series"), measured, keys, self._home(), marks=marks)

    # -- the KPI tables -----------------------------------------------------------------------------------------

    def bounds(self, last_day: Column) -> DataFrame:
        """First and last calendar day, as ``gold.calendar_bounds`` gives them."""
        first = self.read("days").agg(F.min("day_key").alias("k"))
        start = F.coalesce(day_of_key("k"), F.lit(gold.FALLBACK_START).cast("date"))
        return first.select(start.alias("start"), last_day.cast("date").alias("end"))

    def repo_health(self, dim_repositories: DataFrame) -> DataFrame:
        return kpis.health_rows(dim_repositories, self.read("health"))

    def time_series(self, dim_repositories: DataFrame, bounds: DataFrame) -> DataFrame:
        calendar = kpis.limits(bounds)
        return kpis.series_rows(dim_repositories, self.read("series"), calendar.getField("start"), calendar.getField("end"))

    def user_contributions(self, dim_repositories: DataFrame, dim_users: DataFrame, null_safe: bool = False) -> DataFrame:
        return kpis.contribution_rows(self.read("users").drop("n_rows"), dim_repositories, dim_users, null_safe)


def _authors(issues: DataFrame, prs: DataFrame) -> DataFrame:
    work = kpis.work_items(issues, prs)
    return work.select("repo_id", "kind", "author_user_id", F.lit(1).alias("n"), F.coalesce(F.col("state") == "open", F.lit(False)).cast("int").alias("n_open"))


def _months(issues: DataFrame, prs: DataFrame) -> DataFrame:
    dated = kpis.milestones(issues, prs)
    return dated.select("repo_id", month_of_key("day_key").alias("month_year"), "kind", "hours", F.lit(1).alias("n_rows"))


def _users(issues: DataFrame, prs: DataFrame) -> DataFrame:
    amounts = [F.coalesce(c, F.lit(0)).alias(c) for c in kpis.CONTRIBUTIONS]
    return kpis.deeds(issues, prs).select("repo_id", "user_id", F.lit(1).alias("n_rows"), *amounts)


def _days(issues: DataFrame, prs: DataFrame) -> DataFrame:
    def created(df: DataFrame, kind: str) -> DataFrame:
        day = F.col("created_date_key").alias("day_key")
        return df.select(F.lit(kind).alias("kind"), day, F.lit(1).alias("n_rows")).filter(day.isNotNull())

    return created(issues, "issue").unionByName(created(prs, "pr"))
