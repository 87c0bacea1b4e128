"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.exact_dedup import SQL as EXACT_SQL
from strata.llm.exact_dedup import exact_copies
from strata.llm.fingerprint import edited_likeness
from strata.llm.html_extract import extract_text
from strata.llm.lm_score import score_documents
from strata.llm.mixing import SQL as MIXING_SQL
from strata.llm.mixing import mixture
from strata.llm.near_dedup import near_components
from strata.llm.packing import pack_documents
from strata.llm.periodic_runs import periodic_runs, run_digests, tail_repeated
from strata.llm.quality import score_quality
from strata.llm.ship import documents
from strata.llm.spelling import variant_forms, word_counts
from strata.llm.substring_dedup import drop_repeats
from strata.llm.token_files import read_token_files, write_token_files
from strata.llm.tokens import tokenizer_path
from strata.llm.toxicity import score_toxicity
from strata.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add


@register()
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return near_components(documents(spark, sf_dir))


@register()
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree and word-frequency scores of all documents, learned outside fold 2 of 7."""
    return score_documents(documents(spark, sf_dir))


@register()
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    folder = scratch_dir(spark, "token-files")
    write_token_files(documents(spark, sf_dir), folder, tokenizer_path("word_bpe_49k.json"))
    return read_token_files(spark, folder).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@register()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    pieces = pack_documents(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@register(EXACT_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of exact copies among all documents."""
    return exact_copies(documents(spark, sf_dir))


@register()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labelled ones outside fold 0."""
    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register()
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences that repeat earlier passages."""
    return drop_repeats(documents(spark, sf_dir).select("doc_id", "text"))


@register()
def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how near these and the next document are."""
    return edited_likeness(documents(spark, sf_dir))


@register(MIXING_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken when no source is repeated more than twice."""
    return mixture(documents(spark, sf_dir))


@register()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labelled ones outside fold 0."""
    scored = score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", "held_out", "score", "predicted", "n_tokens", F.size("segments").alias("n_segments"))


@register()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents, a tenth of which get a repeated tail first."""
    docs = documents(spark, sf_dir)
    return run_digests(periodic_runs(docs.select("doc_id", tail_repeated(docs["doc_id"], docs["text"]).alias("text"))))


@register()
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of all words of all documents, one in 31 of which loses a letter first."""
    return variant_forms(word_counts(documents(spark, sf_dir), slips=31))


@register()
def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
