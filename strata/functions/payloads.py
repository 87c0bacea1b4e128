"""Schema-on-read: typed columns out of a JSON text column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_json(
    df: DataFrame,
    col: str,
    schema: str,
    mapping: Mapping[str, str | Column],
    keep: Sequence[str | Column] = (),
) -> DataFrame:
    """Parse ``col`` once and project ``{output name: field path or expression over payload.*}``.

    Unparsable text gives null fields, never an error. Spark prunes the parse to the fields used downstream.
    """
    parsed = df.withColumn("payload", F.from_json(col, schema))
    fields = [
        (F.col(f"payload.{path}") if isinstance(path, str) else path).alias(name) for name, path in mapping.items()
    ]
    return parsed.select(*fields, *keep)


def parsed_timestamp(path: str) -> Column:
    """Timestamp of an ISO text field; malformed text becomes null so that a quality rule can catch it."""
    return F.col(f"payload.{path}").try_cast("timestamp")


def explode_map(df: DataFrame, col: str, key_name: str, value_name: str, value_type: str = "bigint") -> DataFrame:
    """One row per entry of a JSON object column; an empty or malformed object gives no rows."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode(F.from_json(col, f"map<string,{value_type}>")).alias(key_name, value_name))


def canonical_json(cols: Sequence[str]) -> Column:
    """JSON text with columns in name order and nulls kept: equal records give equal text."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]), {"ignoreNullFields": "false"})


def payload_checksum(cols: Sequence[str]) -> Column:
    return F.sha2(canonical_json(cols), 256)
