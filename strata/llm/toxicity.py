"""Toxic passages: maximal scoring segments over token log-odds, judged by extreme-value statistics.

A token's weight is its log-odds between toxic and other training documents, both smoothed by a Dirichlet prior that
adds ``PRIOR`` occurrences to every token, shared among the classes by their sizes, less a drift that makes ordinary
text score below zero. Tokens are hashed into a fixed number of slots, so the model's size doesn't grow. In each
document a linear-time scan (Ruzzo and Tompa's) finds every maximal scoring segment. Segment scores in clean text follow an
extreme-value law: their expected number at or above S in n tokens is ``K n exp(-decay S)``, with the decay from
the clean tokens' weights and K from the clean training documents. A document's evidence is that of its best segment
and the sum over its significant ones; a logistic curve makes it a score. K and the curve are fitted on the training
documents, each judged by the counts of the other half of them.

Rows: null, empty and white-space texts have no tokens, no segments, and the score of a document without evidence.
Repeated rows are scored each; a null doc_id is scored and counts as held out by the fold of the empty text. Without
training rows of both classes every score is 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import FOLDS, MOST_LABELS, held_out, training_documents
from strata.llm.ship import fold, ship, tidied, tidy
from strata.llm.text import slices, word_hashes
from strata.session import written

SLOT_BITS = 20
PRIOR = 4.0
DRIFT = 1.5
SIGNIFICANT = 0.05  # expected number of such segments in a clean document of that length
SEGMENTS = "array<struct<first_word: long, last_word: long, score: double, expected: double>>"


@dataclass
class Model:
    weights: np.ndarray  # float32, by slot
    decay: float
    constant: float  # the logarithm of K
    curve: np.ndarray  # of the logistic function: one, best, sum, share


def _slots(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 << SLOT_BITS
    total = np.zeros((2, 2 * size), np.int64)  # by label, then by half and slot
    for batch in batches:
        label, half = batch.column("label").to_numpy(), batch.column("half").to_numpy()
        for row, end, data, offsets in slices(batch.column("text")):
            words, first = word_hashes(data, offsets)
            n = np.diff(first)
            toxic = np.repeat(label[row:end], n) == 1
            slots = _slots(words) + np.repeat(half[row:end], n) * size
            for k in (0, 1):
                total[k] += np.bincount(slots[toxic == k], minlength=2 * size)
    some = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (some, *total[:, some])], ["slot", "other", "toxic"])


def _weights(other: np.ndarray, toxic: np.ndarray) -> np.ndarray | None:
    size, part = np.array([other.sum(), toxic.sum()]), []
    if not size.all():
        return None
    for k, count in enumerate((other, toxic)):
        part.append(np.log((count + PRIOR * size[k] / size.sum()) / size[k]))
    return (part[1] - part[0] - DRIFT).astype(np.float32)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence, in one pass.

    ``scores`` may hold the sums of runs of one sign; positions are those of the runs.
    """
    kept: list[tuple[int, int, float, float, int]] = []  # first, last, total before it, total with it, link
    total = 0.0
    for k, s in enumerate(scores.tolist()):
        before, total = total, total + s
        if s <= 0:
            continue
        first, j = k, len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]  # those between don't begin lower than this one
            if j < 0 or kept[j][3] >= total:
                break
            first, _, before, _, link = kept[j]
            del kept[j:]
            j = link
        kept.append((first, k, before, total, j))
    return [(a, b, high - low) for a, b, low, high, _ in kept]


def _scan(column: pa.Array, weights: np.ndarray) -> Iterator[tuple[int, list[int], list[list[tuple[int, int, float]]]]]:
    """Number of tokens and segments (first word, last word, score) of each row, some rows at a time."""
    for row, end, data, offsets in slices(column):
        words, first = word_hashes(data, offsets)
        weight = weights[_slots(words)].astype(np.float64)
        positive = weight > 0
        hit = np.concatenate(([0], np.cumsum(positive)))[first]
        found = []
        for k in range(end - row):
            if hit[k] == hit[k + 1]:
                found.append([])
                continue
            own, sign = weight[first[k] : first[k + 1]], positive[first[k] : first[k + 1]]
            begin = np.flatnonzero(np.concatenate(([True], sign[1:] != sign[:-1])))
            stop = np.append(begin[1:], len(own))
            best = segments(np.add.reduceat(own, begin))
            found.append([(int(begin[a]), int(stop[b]) - 1, s) for a, b, s in best])
        yield row, np.diff(first).tolist(), found


def _evidence(n: int, found: list, decay: float, constant: float) -> tuple[list[float], list[float]]:
    """What the curve takes (one, best, sum, share), and the expected number for each segment.

    ``constant`` is the logarithm of K.
    """
    expected = [constant + np.log(n) - decay * s for _, _, s in found]
    sure = [-e for e in expected if e < np.log(SIGNIFICANT)]
    best = max(sure, default=0.0)
    x = [1.0, float(np.log1p(best)), float(np.log1p(sum(sure))), float(np.log1p(1000 * len(sure) / n)) if n else 0.0]
    return x, [float(np.exp(min(e, 700.0))) for e in expected]


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a small ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Model | None:
    """A model of ``labels.toxic`` from the training folds; None without rows of both classes."""
    ship(docs.sparkSession)
    half = (fold(F.col("doc_id"), 2 * FOLDS) / FOLDS).cast("int").alias("half")
    training = training_documents(docs, labels, "toxic", most).select("text", "label", half)
    counted = training.mapInArrow(tidied(_count), "slot long, other long, toxic long")
    table = counted.groupBy("slot").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()
    counts = np.zeros((2, 2 << SLOT_BITS))
    counts[:, table["slot"].to_numpy()] = table["other"].to_numpy(), table["toxic"].to_numpy()
    counts = counts.reshape(2, 2, -1)  # label, half, slot
    weights = _weights(*counts.sum(axis=1))
    if weights is None:
        return None
    decay = _decay(weights.astype(np.float64), counts[0].sum(axis=0) / counts[0].sum())
    # a document's own words don't count when it is judged for the fit: the other half's weights are used
    apart = [_weights(*counts[:, 1 - h]) for h in (0, 1)]
    apart = [weights if w is None else w for w in apart]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h in (0, 1):
                some = batch.filter(pc.equal(batch.column("half"), h))
                for row, n, found in _scan(some.column("text"), apart[h]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("label").slice(row, len(n)),
                            pa.array(n, pa.int64()),
                            pa.array([[s for _, _, s in f] for f in found], pa.list_(pa.float64())),
                        ],
                        ["label", "n", "scores"],
                    )

    # segments grow with the texts: they stay in a table, and of each row four numbers reach the driver
    rows = written(training.mapInArrow(tidied(scan), "label int, n long, scores array<double>"), "segment-scores")
    best = F.coalesce(F.array_max("scores"), F.lit(0.0))
    tail = F.sum(F.col("n") * F.exp(-F.lit(decay) * best))
    clean = rows.filter("label = 0 and n > 0").agg(F.count(F.lit(1)).alias("rows"), tail.alias("tail")).first()
    constant = float(np.log(max(clean["rows"], 1)) - np.log(max(clean["tail"] or 0.0, 1e-9)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("n").to_pylist(), batch.column("scores").to_pylist(), strict=True)
            x = [_evidence(n, [(0, 0, s) for s in scores], decay, constant)[0] for n, scores in pairs]
            columns = np.array(x).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column("label"), *map(pa.array, columns)], ["label", *"abcd"])

    kinds = "label int, a double, b double, c double, d double"
    found = rows.mapInArrow(tidied(weigh), kinds).toArrow()  # ``most`` rows of fixed width
    x = np.stack([found[c].to_numpy() for c in "abcd"], axis=1)
    return Model(weights, decay, constant, _fit_curve(x, found["label"].to_numpy().astype(float)))


def _decay(weights: np.ndarray, share: np.ndarray) -> float:
    """The positive root of ``sum(share * exp(decay * weight)) = 1``."""
    weights, share = weights[share > 0], share[share > 0]
    low, high = 1e-6, 50.0
    for _ in range(80):
        middle = (low + high) / 2
        if np.log(share).max() + middle * weights.max() > 700 or (share * np.exp(np.minimum(middle * weights, 700))).sum() > 1:
            high = middle
        else:
            low = middle
    return low


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, n_tokens, segments, score of every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if model is None:
        return rows.select(
            "doc_id",
            F.lit(None).cast("long").alias("n_tokens"),
            F.lit(None).cast(SEGMENTS).alias("segments"),
            F.lit(0.0).alias("score"),
        )
    held = spark.sparkContext.broadcast(model)  # of a fixed size
    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for row, sizes, found in _scan(batch.column("text"), m.weights):
                lists, scores = [], []
                for n, f in zip(sizes, found, strict=True):
                    x, expected = _evidence(n, f, m.decay, m.constant)
                    scores.append(1 / (1 + np.exp(-np.clip(np.dot(x, m.curve), -30, 30))))
                    lists.append(
                        [dict(first_word=a, last_word=b, score=s, expected=e) for (a, b, s), e in zip(f, expected, strict=True)]
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, len(sizes)),
                        pa.array(sizes, pa.int64()),
                        pa.array(lists, kind),
                        pa.array(scores, pa.float64()),
                    ],
                    ["doc_id", "n_tokens", "segments", "score"],
                )

    return rows.mapInArrow(tidied(run), f"doc_id long, n_tokens long, segments {SEGMENTS}, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_tokens and the segments of every row of ``docs``."""
    model = fit(docs, labels)
    tidy()  # the counts came to the driver, which goes on
    found = score(docs, model)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", held_out(), "score", predicted, "n_tokens", "segments")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    spark = docs.sparkSession
    model = fit(docs, labels)
    tidy()
    if model is None:
        return docs
    held = spark.sparkContext.broadcast(model)
    return docs.filter(_is_clean(held)(F.col("text")))


def _is_clean(held):
    """A test on the text column, so that rows needn't be joined back to their scores."""

    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = held.value
        for text in texts:
            out: list[bool] = []
            for _, sizes, found in _scan(pa.array(text, pa.large_string(), from_pandas=True), m.weights):
                evidence = [_evidence(n, f, m.decay, m.constant)[0] for n, f in zip(sizes, found, strict=True)]
                out += (np.array(evidence) @ m.curve < 0).tolist()
            yield pd.Series(out, dtype=bool)

    return F.pandas_udf(clean, "boolean")
