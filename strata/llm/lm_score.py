"""Language-model scores of documents: context-tree weighting beside a base of smoothed word frequencies.

Training rows are those outside fold 2 of 7; all rows are scored. The base needs the training count of every word of
every document, exactly. Words that are common in a small sample of documents (a fixed number, by hash) are counted
along with the contexts, and their counts are broadcast: at most ``COMMON`` of them. All others go through one shuffle by
word, which counts them and gives each document its part. The sample decides only which way a word takes, not its count.

Words are known by 64-bit hashes. Rows: null text counts as empty and has one token, the end. Repeated rows are scored
each. A null doc_id has the fold of the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from strata.llm import context_tree as C
from strata.llm.ship import fold, ship
from strata.llm.text import slices, word_hashes
from strata.session import written

FOLDS, HELD = 7, 2
SAMPLE_ROWS = 4000
COMMON = 1 << 16
DOCS_KEY, WORDS_KEY, RUNS_KEY = -1, -2, -3  # of the counts table; common words come below them


def _common_words(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of words that occur three times or more in the sample."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                found, n = np.unique(word_hashes(data, offsets)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["word", "n"])

    # identifiers first, then the few texts: a limit over texts would carry them through one task
    chosen = rows.select("key").orderBy("key").limit(SAMPLE_ROWS)
    sample = rows.select("key", "text").join(F.broadcast(chosen), "key", "left_semi").select("text")
    counted = sample.mapInArrow(words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    most = counted.filter("n >= 3").orderBy(F.desc("n"), "word").limit(COMMON)
    return np.sort(most.select("word").toArrow()["word"].to_numpy().view(np.uint64))


def _find(words: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word among the common ones, and whether it is one."""
    at = np.searchsorted(common, words)
    at[at == len(common)] = 0
    return at, (common[at] == words) if len(common) else np.zeros(len(words), bool)


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    ship(spark)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.xxhash64(doc_id, F.col("text")).alias("key"),
        (fold(doc_id, FOLDS) == HELD).alias("held_out"),
        "text",
    )
    common = _common_words(rows)
    shared = spark.sparkContext.broadcast(common)  # COMMON hashes at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys, counts):
            for k in range(0, len(keys), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(keys[part].astype(np.int64)), pa.array(counts[part])], ["key", "n"])

        known = shared.value
        total, n_docs, n_words, n_runs, held = np.zeros(len(known), np.int64), 0, 0, 0, C.GramCounts()

        def runs():
            held.settle()  # runs of held-out rows have a last bit set and count 0
            return held.keys >> np.uint64(1), np.where(held.keys & np.uint64(1) == 1, 0, held.counts)

        for batch in batches:
            out_of = batch.column("held_out").to_numpy(zero_copy_only=False)
            for row, end, data, offsets in slices(batch.column("text")):
                found, begins = C.grams(data, offsets)
                held.add((found << np.uint64(1)) | np.repeat(out_of[row:end], np.diff(begins)).astype(np.uint64))
                words, first = word_hashes(data, offsets)
                words = words[np.repeat(~out_of[row:end], np.diff(first))]
                at, hit = _find(words, known)
                total += np.bincount(at[hit], minlength=len(known))
                n_docs, n_words = n_docs + int((~out_of[row:end]).sum()), n_words + len(words)
                n_runs += len(found)
            if len(held.keys) >= 2 * C.HELD_GRAMS:
                yield from out(*runs())
                held = C.GramCounts()
        yield from out(*runs())
        some = np.flatnonzero(total)
        yield from out(
            np.concatenate(([DOCS_KEY, WORDS_KEY, RUNS_KEY], RUNS_KEY - 1 - some)),
            np.concatenate(([n_docs, n_words, n_runs], total[some])),
        )

    counted = rows.select("held_out", "text").mapInArrow(count, "key long, n long")
    counts = written(counted.groupBy("key").agg(F.sum("n").alias("n")), "gram-counts")
    own = counts.filter("key < 0").toArrow()  # COMMON rows and three
    keys, n = own["key"].to_numpy(), own["n"].to_numpy()
    n_docs, n_words, n_runs = (int(n[keys == k].sum()) for k in (DOCS_KEY, WORDS_KEY, RUNS_KEY))
    times = np.zeros(len(common), np.int64)
    times[RUNS_KEY - 1 - keys[keys < RUNS_KEY]] = n[keys < RUNS_KEY]

    rare = _rare_parts(rows, shared)
    others = rare.agg(F.sum("distinct")).first()[0] or 0
    train_tokens = n_words + n_docs
    vocabulary = int(others) + int((times > 0).sum()) + (n_docs > 0)
    held = spark.sparkContext.broadcast(times)  # of a fixed size
    chunks = 1 + n_runs // C.CHUNK_RUNS
    by_run = written(C.run_scores(C.by_context(counts.filter("key >= 0")), chunks), "run-scores")
    end_part = float(np.log10(n_docs + 1))

    def ask(table: pa.Table) -> pa.Table:
        text = table["text"].combine_chunks()
        keys = C.distinct_runs((data, offsets) for _, _, data, offsets in slices(text))
        order, edge = C.in_buckets(keys, chunks)
        some = np.flatnonzero(np.diff(edge))
        asked = [C.packed(keys[order[edge[k] : edge[k + 1]]]) for k in some]
        chunk = pa.array(np.full(len(some), table["chunk"][0].as_py()), pa.int64())
        return pa.table({"chunk": chunk, "bucket": pa.array(some, pa.int64()), "runs": pa.array(asked, pa.binary())})

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        batches = table.combine_chunks().to_batches()
        keys = C.distinct_runs((data, offsets) for b in batches for _, _, data, offsets in slices(b.column("text")))
        order, _ = C.in_buckets(keys, chunks)
        found = np.empty(len(keys), "<f4")
        answers = answers.sort_by("bucket")["scores"].to_pylist()
        found[order] = np.concatenate([np.frombuffer(r, "<f4") for r in answers])
        return pa.Table.from_batches(_score(batches, C.Scorer(C.Known(keys, found))))

    def _score(batches: list[pa.RecordBatch], scorer: C.Scorer) -> Iterator[pa.RecordBatch]:
        count_of, known = held.value, shared.value
        logs = np.log10(count_of + 1.0)
        for batch in batches:
            for row, end, data, offsets in slices(batch.column("text")):
                found, begins = C.grams(data, offsets)
                total = np.add.reduceat(scorer(found).astype(np.float64), begins[:-1])
                words, first = word_hashes(data, offsets)
                at, hit = _find(words, known)
                whose = np.repeat(np.arange(end - row), np.diff(first))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(row, end - row) for c in ("doc_id", "key", "held_out")),
                        pa.array(np.diff(first) + 1),
                        pa.array(np.diff(offsets)),
                        pa.array(np.bincount(whose[hit], count_of[at[hit]] > 0, end - row).astype(np.int64)),
                        pa.array(np.bincount(whose[hit], logs[at[hit]], end - row).astype(np.float64)),
                        pa.array(total),
                    ],
                    ["doc_id", "key", "held_out", "n_tokens", "n_bytes", "known", "part", "score"],
                )

    # both sides of the question read the same exchange
    texts = rows.withColumn("chunk", F.pmod("key", F.lit(chunks))).repartition(chunks, "chunk")
    asked = texts.groupBy("chunk").applyInArrow(ask, "chunk long, bucket long, runs binary")
    scored = texts.groupBy("chunk").cogroup(C.answered(by_run, asked).groupBy("chunk")).applyInArrow(
        score,
        "doc_id long, key long, held_out boolean, n_tokens long, n_bytes long, known long, part double, score double",
    )
    joined = scored.join(rare.select("key", "rare_known", "rare_part"), "key", "left")
    unit = float(np.log10(train_tokens + vocabulary + 1))
    base = F.col("part") + F.coalesce("rare_part", F.lit(0.0)) + F.lit(end_part) - F.col("n_tokens") * F.lit(unit)
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + int(n_docs > 0)).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        (-F.col("score") / float(np.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def _rare_parts(rows: DataFrame, shared) -> DataFrame:
    """For each document what its other words add: known tokens, sum of log10(count + 1), words first met in it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            key, train = batch.column("key").to_numpy(), ~batch.column("held_out").to_numpy(zero_copy_only=False)
            for row, end, data, offsets in slices(batch.column("text")):
                words, first = word_hashes(data, offsets)
                hit = _find(words, known)[1]
                whose = np.repeat(np.arange(end - row), np.diff(first))[~hit]
                words = words[~hit]
                order = np.lexsort((words, whose))
                words, whose = words[order], whose[order]
                new = np.ones(len(words), bool)
                new[1:] = (words[1:] != words[:-1]) | (whose[1:] != whose[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(words)))
                owner = row + whose[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(words[at].view(np.int64)),
                        pa.array(key[owner]),
                        pa.array((times * 2 + train[owner]).astype(np.int32)),
                    ],
                    ["word", "key", "times"],
                )

    rare = rows.select("key", "held_out", "text").mapInArrow(emit, "word long, key long, times int")
    by_word = W.Window.partitionBy("word")
    times = F.expr("shiftright(times, 1)")
    train = F.when(F.col("times") % 2 == 1, times).otherwise(0)
    counted = rare.select(
        "key",
        times.alias("own"),
        F.sum(train).over(by_word).alias("c"),
        F.row_number().over(by_word.orderBy("key")).alias("place"),
    )
    parts = counted.groupBy("key").agg(
        F.sum(F.when(F.col("c") > 0, F.col("own")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("own") * F.log10(F.col("c") + 1)).alias("rare_part"),
        F.sum(F.when((F.col("c") > 0) & (F.col("place") == 1), 1).otherwise(0)).alias("distinct"),
    )
    copies = rows.groupBy("key").agg(F.count("*").alias("copies"))
    return written(
        parts.join(copies, "key").select(
            "key",
            F.expr("rare_known div copies").alias("rare_known"),
            (F.col("rare_part") / F.col("copies")).alias("rare_part"),
            "distinct",
        ),
        "rare-parts",
    )
