"""Keep the newest row of every key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie_break: Sequence[str] | None = None,
    null_keys: str = "keep",
) -> DataFrame:
    """Newest row per key by ``order`` (all descending), ties settled by ``tie_break`` or a row hash.

    Spark places a WindowGroupLimit before the shuffle, so each input partition sends at most one row per key and
    a key that holds a large share of the rows reaches its task already cut down. Rows with a null key are not
    duplicates of each other: ``null_keys`` keeps them all or drops them.
    """
    if null_keys not in ("keep", "drop"):
        raise ValueError("null_keys is 'keep' or 'drop'")
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    if tie_break is None:
        hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
        ties = [F.xxhash64(*hashable).desc()]
    else:
        ties = [F.col(c).desc() for c in tie_break]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order], *ties)
    newest = df.filter(~any_null).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    # rows with a null key need no window and no shuffle
    return newest if null_keys == "drop" else newest.unionByName(df.filter(any_null))
