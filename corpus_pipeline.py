"""Training data from the documents: toxic ones out, copies out, sources mixed, and what is left packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``docs``. The mixture takes every document at least once and repeats
those of smaller sources up to twice, so it drops none; a repeated document is packed as often as it is taken.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.exact_dedup import drop_copies
from strata.llm.mixing import mixed
from strata.llm.near_dedup import drop_near_copies
from strata.llm.packing import pack_documents
from strata.llm.ship import documents
from strata.llm.tokens import tokenizer_path
from strata.llm.toxicity import drop_toxic
from strata.session import written_alone


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: The classifier, the near-copy groups and the token ids have no SQL; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents of ``sf_dir``. Helper tables of a stage go once its result is written."""
    rows = documents(spark, sf_dir)
    for name, stage in STAGES:
        rows = written_alone(spark, partial(stage, spark, rows, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return rows
