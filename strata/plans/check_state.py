"""Integrity checks kept by signed deltas: a changed row takes back what it broke before and adds what it breaks now.

Every check is a count of values: how often a key occurs (unique, one open version), how many children and parents a key has
(relationships), how many rows lack a value (not null). The counts follow the change feeds of the checked tables, and the number
of violations follows the counts, so a day's check reads the day's changes and the counts of their values, never a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.changes import CHANGE, ChangeLog, merge_logged
from strata.sources.tables import hash_bucket, read_table

#: what each kind of change adds to the rows that hold
SIGNS = {"before": -1, "after": 1, "opened": 1, "closed": -1}


@dataclass(frozen=True)
class Check:
    """``kind`` is not_null, unique, one_current or relationships; ``table`` and ``parent`` are names of logged tables."""

    kind: str
    table: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind} {self.table} {','.join(self.columns)}"

    def sides(self) -> list[tuple[str, tuple[str, ...], str]]:
        """Source, its columns, and the count they go to."""
        own = [(self.table, self.columns, "n_rows")]
        return own if self.parent is None else [*own, (self.parent, self.parent_columns, "n_parents")]

    def violations(self, row: Column) -> Column:
        """What a value's counts come to; 0 where there is no row."""
        rows, parents = row.getField("n_rows"), row.getField("n_parents")
        if self.kind == "not_null":
            found = rows
        elif self.kind == "relationships":
            found = F.when(parents == 0, rows).otherwise(F.lit(0))
        else:
            found = (rows > 1).cast("long")
        return F.coalesce(found, F.lit(0)).cast("long")


class CheckState:
    """Counts and violations below one folder; ``paths`` names the logged tables that are checked."""

    def __init__(self, spark: SparkSession, root: str, paths: dict[str, str], checks: Sequence[Check], buckets: int = 16):
        self.spark, self.root, self.paths, self.checks, self.buckets = spark, root.rstrip("/"), paths, checks, buckets

    def refresh(self) -> None:
        """Bring all counts and violations up to the tables' last writes."""
        values, marks = self._deltas()
        path = f"{self.root}/values"
        if values is not None:
            keys = ["check", "value"]

            def merged(old: Column, new: Column) -> Column:
                total = {c: F.coalesce(old.getField(c), F.lit(0)) + new.getField(c) for c in ("n_rows", "n_parents")}
                row = new.withField("n_rows", total["n_rows"]).withField("n_parents", total["n_parents"])
                return F.when((total["n_rows"] != 0) | (total["n_parents"] != 0), row)

            merge_logged(self.spark, path, values, keys, hash_bucket(keys, self.buckets), merged, marks)
        self._total(path)

    def _deltas(self) -> tuple[DataFrame | None, dict[str, int]]:
        known = ChangeLog(self.spark, f"{self.root}/values").marks()
        found, marks = [], {}
        for check in self.checks:
            for source, columns, counted in check.sides():
                log, mark = ChangeLog(self.spark, self.paths[source]), f"{check.name} @ {source}"
                marks[mark] = log.newest()
                feed = log.since(known.get(mark, 0))
                if feed is None:
                    continue
                lacking = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
                if check.kind == "not_null":
                    rows, value = feed.filter(lacking), F.lit("")
                else:
                    rows, value = feed.filter(~lacking), F.concat_ws("\x1f", *[F.col(c).cast("string") for c in columns])
                sign = F.coalesce(*[F.when(F.col(CHANGE) == c, n) for c, n in SIGNS.items()], F.lit(0))
                counts = [(F.lit(0) if c != counted else sign).cast("long").alias(c) for c in ("n_rows", "n_parents")]
                found.append(rows.select(F.lit(check.name).alias("check"), value.alias("value"), *counts))
        if not found:
            return None, marks
        sums = reduce(DataFrame.unionByName, found).groupBy("check", "value").agg(
            F.sum("n_rows").alias("n_rows"), F.sum("n_parents").alias("n_parents")
        )
        return sums.filter("n_rows <> 0 or n_parents <> 0"), marks

    def _total(self, path: str) -> None:
        """Violations per check: a handful of rows, moved by what the changed values came to before and after."""
        totals, log = f"{self.root}/violations", ChangeLog(self.spark, path)
        feed = log.since(ChangeLog(self.spark, totals).marks().get("values", 0))
        if feed is None:
            return
        row = F.struct("n_rows", "n_parents")
        each = F.coalesce(*[F.when(F.col("check") == c.name, c.violations(row)) for c in self.checks], F.lit(0).cast("long"))
        sign = F.when(F.col(CHANGE) == "after", 1).otherwise(-1)
        deltas = feed.groupBy("check").agg(F.sum(each * sign).alias("violations"))
        merge_logged(
            self.spark, totals, deltas, ["check"], F.lit(0),
            lambda old, new: new.withField(
                "violations", F.coalesce(old.getField("violations"), F.lit(0)) + new.getField("violations")
            ),
            {"values": log.newest()},
        )

    def violations(self) -> DataFrame:
        """One row per check: check, violations."""
        names = self.spark.createDataFrame([(c.name,) for c in self.checks], "check string")
        held = read_table(self.spark, f"{self.root}/violations")
        if held is None:
            return names.withColumn("violations", F.lit(0).cast("long"))
        return names.join(held, "check", "left").select("check", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))
