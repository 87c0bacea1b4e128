"""Type-2 history: incremental application of a batch, and set-based construction from a change log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import written

META = ("scd_id", "valid_from", "valid_to")


def scd_id(keys: Sequence[str], valid_from: str | Column = "valid_from") -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], _col(valid_from).cast("string")))


def scd2_apply(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    strategy: str,
    updated_at: str | None = None,
    check_cols: Sequence[str] = (),
    as_of: Column | None = None,
    hard_deletes: str = "ignore",
    refresh: Sequence[str] = (),
) -> DataFrame:
    """History after one batch. ``source`` holds at most one row per key; null keys are left out.

    ``timestamp`` opens a version when ``updated_at`` is newer than the open one and dates it by ``updated_at``;
    ``check`` opens one when any of ``check_cols`` differs (null-safe) and dates it ``as_of``. Keys missing from
    the batch stay open unless ``hard_deletes="close"``. Closed rows pass through; only open rows meet the batch,
    in a single full outer join. ``refresh`` names columns that an open version takes from the batch without a new
    version, when the batch holds the same ``valid_from`` (measures that arrive later than their record).
    """
    _check(strategy, updated_at, check_cols, as_of, hard_deletes)
    fresh = _versions_of(source, keys, strategy, updated_at, as_of)
    if target is None:
        return fresh
    opened = target.filter(F.col("valid_to").isNull())
    kept, added = _met(opened, fresh, keys, strategy, check_cols, as_of, hard_deletes, refresh)
    rows = _paired(opened, fresh, keys).select(F.explode(F.array_compact(F.array(kept, added))).alias("v")).select("v.*")
    return target.filter(F.col("valid_to").isNotNull()).unionByName(rows.select(*target.columns))


def scd2_changes(
    opened: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    strategy: str,
    updated_at: str | None = None,
    check_cols: Sequence[str] = (),
    as_of: Column | None = None,
    hard_deletes: str = "ignore",
    refresh: Sequence[str] = (),
) -> DataFrame:
    """Only the versions that a batch changes, each with its ``change``: ``opened``, ``closed`` or ``refreshed``.

    ``opened`` holds the open versions. Arguments as for :func:`scd2_apply`, which gives the same versions among all.
    """
    _check(strategy, updated_at, check_cols, as_of, hard_deletes)
    fresh = _versions_of(source, keys, strategy, updated_at, as_of)
    if opened is None:
        return fresh.withColumn("change", F.lit("opened"))
    kept, added = _met(opened, fresh, keys, strategy, check_cols, as_of, hard_deletes, refresh)
    differs = reduce(Column.__or__, [~F.col(f"o.{c}").eqNullSafe(kept.getField(c)) for c in refresh], F.lit(False))
    change = F.when(kept.getField("valid_to").isNotNull(), "closed").when(differs, "refreshed")
    pair = F.array(
        F.when(change.isNotNull(), F.struct(kept.alias("v"), change.alias("change"))),
        F.when(added.isNotNull(), F.struct(added.alias("v"), F.lit("opened").alias("change"))),
    )
    rows = _paired(opened, fresh, keys).select(F.explode(F.array_compact(pair)).alias("c"))
    return rows.select("c.v.*", "c.change").select(*opened.columns, "change")


def _check(strategy: str, updated_at: str | None, check_cols: Sequence[str], as_of: Column | None, hard_deletes: str) -> None:
    if strategy == "timestamp":
        if updated_at is None:
            raise ValueError("the timestamp strategy needs updated_at")
    elif strategy != "check":
        raise ValueError("strategy is 'timestamp' or 'check'")
    elif not check_cols or as_of is None:
        raise ValueError("the check strategy needs check_cols and as_of")
    if hard_deletes == "close" and as_of is None:
        raise ValueError("closing deleted keys needs as_of")


def _versions_of(source: DataFrame, keys: Sequence[str], strategy: str, updated_at: str | None, as_of: Column | None) -> DataFrame:
    """The batch as versions that would open."""
    starts = F.col(updated_at) if strategy == "timestamp" else as_of
    fresh = source.dropna(subset=list(keys))
    fresh = fresh.withColumn("valid_from", starts).withColumn("valid_to", F.lit(None).cast(_type(fresh, starts)))
    return fresh.withColumn("scd_id", scd_id(keys))


def _paired(opened: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Open version ``o`` and batch version ``n`` of every key, in a single full outer join."""
    row = F.struct(*[F.col(c) for c in opened.columns])
    return opened.select(*keys, row.alias("o")).join(fresh.select(*keys, row.alias("n")), list(keys), "full_outer")


def _met(
    opened: DataFrame,
    fresh: DataFrame,
    keys: Sequence[str],
    strategy: str,
    check_cols: Sequence[str],
    as_of: Column | None,
    hard_deletes: str,
    refresh: Sequence[str],
) -> tuple[Column, Column]:
    """Over :func:`_paired`: the open version after the batch, and the version the batch opens; null where there is none."""
    has_old, has_new = F.col("o").isNotNull(), F.col("n").isNotNull()
    if strategy == "timestamp":
        moved = F.col("n.valid_from") > F.col("o.valid_from")
    else:
        moved = reduce(Column.__or__, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in check_cols])
    changed = has_old & has_new & moved
    until = F.when(changed, F.col("n.valid_from"))
    if hard_deletes == "close":
        until = until.when(~has_new, as_of)
    kept = F.col("o").withField("valid_to", until.cast(opened.schema["valid_to"].dataType))
    same = has_new & F.col("n.valid_from").eqNullSafe(F.col("o.valid_from"))
    for c in refresh:
        kept = kept.withField(c, F.when(same, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")))
    return F.when(has_old, kept), F.when(has_new & (~has_old | changed), F.col("n"))


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` written in the order of ``columns`` over all tasks, with each row's partition number as ``__part``.

    Spark samples the splitters from the rows, so a key that holds most of them, or all rows of one day, is cut
    into as many parts as it needs.
    """
    return written(df.repartitionByRange(*columns).withColumn("__part", F.spark_partition_id()), "ordered-log")


def neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], take: Sequence[str], prefix: str, back: bool
) -> DataFrame:
    """Previous (``back``) or next row's ``take`` values within a key, as ``prefix``-named columns.

    ``df`` comes from :func:`in_order` by keys and order; rows may have been filtered since. Equal to lag/lead over
    the whole key, but no task holds a whole key: one window looks within a key's part, a second one across parts,
    where only the first and last row of each part matter. ``{prefix}exists`` tells whether there is such a row.
    """
    direction = [F.col(c).asc() if back else F.col(c).desc() for c in order]
    value = F.struct(*[F.col(c) for c in take])
    within = Window.partitionBy(*keys, "__part").orderBy(*direction)
    near = df.withColumn("__near", F.lag(value).over(within)).withColumn(
        "__last", F.lead(F.lit(1)).over(within).isNull()
    )
    border = F.col("__near").isNull() | F.col("__last")
    grouped = near.withColumn("__group", F.when(~border, F.col("__part")))
    across = Window.partitionBy(*keys, "__group").orderBy(*direction)
    got = grouped.withColumn("__got", F.coalesce("__near", F.lag(value).over(across)))
    return got.select(
        *df.columns,
        F.col("__got").isNotNull().alias(f"{prefix}exists"),
        *[F.col(f"__got.{c}").alias(f"{prefix}{c}") for c in take],
    )


def scd2_from_history(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    check_cols: Sequence[str] | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """All versions of a change log in one pass: what folding :func:`scd2_apply` over its batches would give.

    Without ``check_cols`` every distinct ``ts`` is a version. ``keys`` and ``ts`` must not be null.
    """
    order = [ts, *tie_break]
    versions = in_order(df.dropna(subset=[*keys, ts]), [*keys, *order])
    if check_cols:
        seen = neighbour(versions, keys, order, check_cols, "__prev_", back=True)
        differs = reduce(Column.__or__, [~F.col(c).eqNullSafe(F.col(f"__prev_{c}")) for c in check_cols])
        versions = seen.filter(~F.col("__prev_exists") | differs).select(*versions.columns)
    out = neighbour(versions, keys, order, [ts], "__next_", back=False)
    out = out.withColumn("valid_from", F.col(ts)).withColumn("valid_to", F.col(f"__next_{ts}"))
    return out.select(*df.columns, "valid_from", "valid_to").withColumn("scd_id", scd_id(keys))


def scd2_current(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col("valid_to").isNull())


def scd2_as_of(versions: DataFrame, moment: Column) -> DataFrame:
    """The version of every key that was valid at ``moment``."""
    return versions.filter(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
    )


def version_dimension(versions: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Dimension rows of a history: ``{output name: column}``, the validity range and the is_current flag."""
    return versions.select(
        *[F.col(src).alias(name) for name, src in columns.items()],
        F.col("valid_to").isNull().alias("is_current"),
        "valid_from",
        "valid_to",
    )


def current_view(
    versions: DataFrame, validated: DataFrame, cols: Sequence[str], extra: str | None = None
) -> DataFrame:
    """Open clean versions together with the quarantined rows that never entered history.

    A key that was clean before and fails now shows once from each side; ``record_source`` tells them apart.
    """
    open_rows, bad = scd2_current(versions), validated.filter("is_quarantined")
    if extra:
        open_rows, bad = open_rows.filter(extra), bad.filter(extra)
    dated = versions.schema["valid_from"].dataType
    return open_rows.select(
        *cols,
        "valid_from",
        "valid_to",
        F.array().cast("array<string>").alias("dq_failed_rules"),
        F.lit(False).alias("is_quarantined"),
        F.lit("history").alias("record_source"),
    ).unionByName(
        bad.select(
            *cols,
            F.lit(None).cast(dated).alias("valid_from"),
            F.lit(None).cast(dated).alias("valid_to"),
            "dq_failed_rules",
            "is_quarantined",
            F.lit("quarantine").alias("record_source"),
        )
    )


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _type(df: DataFrame, column: Column):
    return df.select(column.alias("c")).schema["c"].dataType
