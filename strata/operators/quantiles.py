"""Exact quantiles that never hold a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.session import written


def exact_quantile(
    df: DataFrame, keys: Sequence[str], value: str, p: float, name: str, weight: str | None = None
) -> DataFrame:
    """Linearly interpolated quantile of ``value`` per group (nulls skipped), as one row ``keys + [name]``.

    ``weight`` names a column saying how often a row counts. Reads ``df`` once; see :func:`quantile_of_counts`.
    """
    return quantile_of_counts(value_counts(df, value, keys, weight), keys, value, p, name)


#: counted values that one pass of windows over their groups takes; beyond it they are put in order over all tasks
FEW_COUNTS = 4_000_000


@dataclass(frozen=True)
class RankIndex:
    """Counted values in order, with prefix totals: answers any quantiles of any group without sorting again.

    ``values``: group, ``__v``, ``__n`` and its part ``__b``; ``parts``: group, ``__b``, the group's rows before that part and in it, and
    in all. Where there are few counts, a group is one part (``parts`` is None).
    """

    keys: tuple[str, ...]
    values: DataFrame
    parts: DataFrame | None

    def quantiles(self, wanted: dict[str, float], groups: DataFrame | None = None) -> DataFrame:
        """Linearly interpolated quantiles as ``keys + names``, all from one pass; ``groups`` asks for some groups only.

        Of the parts only those are read on that hold a wanted rank.
        """
        keys, values, parts = list(self.keys), self.values, self.parts
        by = [F.col(k) for k in keys]
        if groups is not None:
            values, parts = _of_groups(values, groups, keys), None if parts is None else _of_groups(parts, groups, keys)
        running = Window.orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if parts is None:
            ranked = values.withColumn("__end", F.sum("__n").over(running.partitionBy(*by)))
            ranked = ranked.withColumn("__all", F.sum("__n").over(Window.partitionBy(*by)))
        else:
            position = lambda p: (F.col("__all") - 1) * F.lit(float(p))
            upto = F.col("__before") + F.col("__in")
            hits = [(F.col("__before") <= F.ceil(position(p))) & (F.floor(position(p)) < upto) for p in wanted.values()]
            other = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
            chosen = parts.filter(reduce(Column.__or__, hits)).select(*other, F.col("__b").alias("__wb"), "__before", "__all")
            same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
            ranked = values.join(chosen, reduce(Column.__and__, [*same, F.col("__b") == F.col("__wb")]))
            end = F.col("__before") + F.sum("__n").over(running.partitionBy(*by, "__b"))
            ranked = ranked.withColumn("__end", end)

        def at(rank: Column) -> Column:
            return F.max(F.when((F.col("__end") - F.col("__n") <= rank) & (rank < F.col("__end")), F.col("__v")))

        found, out = [], []
        for i, (name, p) in enumerate(wanted.items()):
            place = (F.col("__all") - 1) * F.lit(float(p))
            found += [at(F.floor(place)).alias(f"__lo{i}"), at(F.ceil(place)).alias(f"__hi{i}")]
            place = (F.col("__rows") - 1) * F.lit(float(p))
            low, high = F.col(f"__lo{i}").cast("double"), F.col(f"__hi{i}").cast("double")
            between = low + (high - low) * (place - F.floor(place))
            out.append(F.when(F.col(f"__lo{i}") == F.col(f"__hi{i}"), low).otherwise(between).alias(name))
        return ranked.groupBy(*keys).agg(*found, F.max("__all").alias("__rows")).select(*keys, *out)


def _of_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    other = groups.select(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__g{i}")) for i, k in enumerate(keys)])
    return rows.join(other, same, "left_semi")


def rank_index(
    counts: DataFrame, keys: Sequence[str], value: str, times: str = "n_rows", few: int = FEW_COUNTS
) -> RankIndex:
    """Rank index of counted values (each value at most once per group; nulls and counts of 0 are left out).

    The built-in exact percentile keeps every distinct value of a group in one task's memory. Here the counts are written
    once. If they are at most ``few`` in all, so is any group, and a window per group ranks them. Else they are put in order
    over all tasks by splitters that Spark samples from what was written, and their number of partition is kept: however the
    values are spread, and whatever share of the rows a group has, no partition is much larger than the others. Both ways
    are exact. Values are compared as they are: integers and decimals exactly, NaN above all others.
    """
    rows = counts.filter(F.col(value).isNotNull() & (F.col(times) > 0)).select(
        *keys, F.col(value).alias("__v"), F.col(times).cast("long").alias("__n")
    )
    seen = Observation()
    stored = written(rows.observe(seen, F.count(F.lit(1)).alias("rows")), "counted-values")
    if seen.get["rows"] <= few:
        return RankIndex(tuple(keys), stored, None)
    by = [F.col(k) for k in keys]
    placed = written(stored.repartitionByRange(*keys, "__v").withColumn("__b", F.spark_partition_id()), "ordered-values")
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = placed.groupBy(*keys, "__b").agg(F.sum("__n").alias("__in"))
    parts = totals.withColumn("__before", F.sum("__in").over(before) - F.col("__in")).withColumn(
        "__all", F.sum("__in").over(Window.partitionBy(*by))
    )
    return RankIndex(tuple(keys), placed, written(parts, "rank-parts"))


def quantile_of_counts(
    counts: DataFrame, keys: Sequence[str], value: str, p: float, name: str, times: str = "n_rows"
) -> DataFrame:
    """One quantile of counted values (each value at most once per group); see :func:`rank_index`."""
    return rank_index(counts, keys, value, times).quantiles({name: p})


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str, weight: str | None = None) -> DataFrame:
    return exact_quantile(df, keys, value, 0.5, name, weight)


def quantile_trim(df: DataFrame, col: str, p: float, weight: str | None = None) -> DataFrame:
    """Rows whose ``col`` is not null and not above its ``p`` quantile."""
    return df.filter(F.col(col) <= exact_quantile(df, [], col, p, "bound", weight).scalar())


def value_counts(df: DataFrame, col: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Distinct non-null values (per ``keys``) and how often they occur, as ``[*keys, col, "n_rows"]``."""
    times = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(times.alias("n_rows"))


def histogram(df: DataFrame, col: str, bins: int, weight: str | None = None) -> DataFrame:
    """Fixed-width histogram of the non-null values over [min, max]: bin number, its edges and its count."""
    times = F.lit(1) if weight is None else F.col(weight)
    seen = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("__x"), times.alias("__n"))
    span = seen.agg(F.struct(F.min("__x").alias("low"), F.max("__x").alias("high")).alias("span")).scalar()
    ranged = seen.withColumn("__span", span)
    low, step = F.col("__span.low"), (F.col("__span.high") - F.col("__span.low")) / F.lit(bins)
    # a constant column has no width: everything is in the first bin; the maximum belongs to the last
    nth = F.coalesce(F.floor((F.col("__x") - low) / F.nullif(step, F.lit(0.0))), F.lit(0))
    nth = F.least(nth, F.lit(bins - 1)).cast("int")
    counted = ranged.groupBy(nth.alias("bin"), low.alias("low"), step.alias("step")).agg(F.sum("__n").alias("n_rows"))
    return counted.select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("step")).alias("bin_from"),
        (F.col("low") + (F.col("bin") + 1) * F.col("step")).alias("bin_to"),
        "n_rows",
    )
