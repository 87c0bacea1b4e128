"""Exact copies by sorting content: equal texts become neighbours, and the row with the smallest doc_id stays.

Normalised texts are range-partitioned by splitters that Spark samples (by the first bytes, then a hash of the whole
text, so that splitters stay small), and sorted within partitions by the whole text with Spark's external sort. There
neighbours are compared in full; each run of equal texts gives its smallest doc_id and its length. A salt of the doc_id
follows the hash in the order, so a text with very many copies is cut into up to ``SALTS`` runs that may lie in
different partitions; the narrow run heads are put together by the SHA-256 of the whole normalised text.

Rows: null text counts as empty, and all empty texts are one group. Of rows that share text and doc_id one is kept; a
null doc_id comes after all others (a group of nulls only keeps one of them, with a null keep_id). An empty table gives
no rows. Other columns are not read. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from strata.session import written

SALTS = 64
HEAD_CHARS = 32

SQL = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as text from documents)
select doc_id, min(doc_id) over (partition by text) as keep_id, count(*) over (partition by text) as group_size,
       doc_id = min(doc_id) over (partition by text) as kept, sha256(text) as text_sha256
from t
"""


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_copies(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col("doc_id").cast("long"), normalised("text").alias("text")).select(
        "doc_id",
        "text",
        F.substring("text", 1, HEAD_CHARS).alias("head"),
        F.xxhash64("text").alias("code"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"),
    )
    run = W.Window.partitionBy("head", "code", "salt", "text")
    sorted_rows = rows.repartitionByRange("head", "code", "salt").select(
        "doc_id",
        F.sha2("text", 256).alias("text_sha256"),
        F.min("doc_id").over(run).alias("first_id"),
        F.count("*").over(run).alias("run_size"),
        F.row_number().over(run.orderBy(F.col("doc_id").asc_nulls_last())).alias("place"),
    )
    runs = written(sorted_rows, "content-sort")
    groups = (
        runs.filter("place = 1")
        .groupBy("text_sha256")
        .agg(F.min("first_id").alias("keep_id"), F.sum("run_size").alias("group_size"))
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1)
    return runs.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )


def _orderable(docs: DataFrame, name: str) -> Column:
    """A column to order by; one that has no order, such as a map, goes by its text."""
    plain = T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DatetimeType
    column = F.col(f"`{name}`")
    return column if isinstance(docs.schema[name].dataType, plain) else column.cast("string")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_copies(docs).filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    coded = docs.withColumn("__sha256", F.sha2(normalised("text"), 256))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__sha256") == F.col("__sha"))
    one = W.Window.partitionBy("__sha", "__id").orderBy(*[_orderable(docs, c) for c in docs.columns])
    found = coded.join(kept, same).withColumn("__place", F.row_number().over(one)).filter("__place = 1")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
