"""Labelled rows for fitting: a bounded sample of the labels, taken by hash, next to their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import fold

MOST_LABELS = 200_000
FOLDS = 5
HELD_OUT = 0


def training_labels(labels: DataFrame, label: str, most: int = MOST_LABELS) -> DataFrame:
    """At most ``most`` rows (doc_id, label), those with the smallest hashes of the doc_id, of the training folds.

    Labels other than 0 and 1 and null ids are left out; of several labels of one document the smallest counts.
    """
    rows = (
        labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
        .filter("label in (0, 1) and doc_id is not null")
        .filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    one = rows.groupBy("doc_id").agg(F.min("label").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def training_documents(docs: DataFrame, labels: DataFrame, label: str, most: int = MOST_LABELS) -> DataFrame:
    """doc_id, text, label of the training documents. The labels are broadcast: ``most`` rows of twelve bytes."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.join(F.broadcast(training_labels(labels, label, most)), "doc_id")


def held_out() -> Column:
    return (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
