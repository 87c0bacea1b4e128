"""Document quality from statistics of the text: random Fourier features, ridge regression, isotonic calibration.

Each document becomes a vector of statistics (sizes, shares of kinds of characters and words, repetition). Cosines of
random projections approximate a Gaussian kernel over the standardised statistics. The normal equations of the ridge
scores are summed within partitions, then over them. A monotone step curve, fitted by pooling neighbours on a quarter of
the training documents that the regression has not seen, turns the scores into probabilities.

Rows: null, empty and white-space texts get statistics of zero and an ordinary score. Repeated rows are scored each; a
null doc_id is scored, its fold is that of the empty text. Without training rows of both classes every score is 0.5.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import MOST_LABELS, held_out, training_documents
from strata.llm.ship import fold, ship
from strata.llm.text import SPACE, distinct, slices, word_bounds, word_hashes
from strata.session import written

COSINES = 384
WIDTH = 3.0
RIDGE = 1.0
PARTS = 16
SEED = 20240229

_KIND = np.full(256, 7, np.uint8)  # 0 space, 1 line end, 2 lower, 3 upper, 4 digit, 5 . and , 6 other ASCII, 7 beyond
_KIND[:128] = 6
_KIND[SPACE] = 0
_KIND[0x0A] = 1
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 2, 3, 4
_KIND[[0x2E, 0x2C]] = 5
KINDS = 8
MARKS = b"!?|#$%&*<>{}/:;=_@"
STATISTICS = KINDS + len(MARKS) + 12


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text."""
    out = []
    for row, end, data, offsets in slices(column):
        n = end - row
        size = np.diff(offsets)
        owner = np.repeat(np.arange(n), size)
        some = np.maximum(size, 1)[:, None]
        kinds = np.bincount(owner * KINDS + _KIND[data], minlength=n * KINDS).reshape(n, KINDS) / some
        marks = np.empty((n, len(MARKS)))
        for k, mark in enumerate(MARKS):
            marks[:, k] = np.bincount(owner[data == mark], minlength=n)
        marks = np.sqrt(marks / some)
        starts, ends, _ = word_bounds(data, offsets)
        words, first = word_hashes(data, offsets)
        count, long = np.diff(first), ends - starts
        whose = np.repeat(np.arange(n), count)
        many = np.maximum(count, 1)
        mean = np.bincount(whose, long, n) / many
        var = np.bincount(whose, (long - mean[whose]) ** 2, n) / many
        last = data[ends - 1] if len(ends) else data[:0]
        ending = np.bincount(whose, (last == 0x2E), n) / many
        odd = np.bincount(whose, (_KIND[last] == 6), n) / many
        upper = np.bincount(whose, _KIND[data[starts]] == 3, n) / many
        again = np.concatenate(([False], words[1:] == words[:-1])) if len(words) else np.zeros(0, bool)
        repeated = np.bincount(whose, again, n) / many
        fresh, top, pairs = np.zeros(n), np.zeros(n), np.zeros(n)
        for k in np.flatnonzero(count):
            own = np.sort(words[first[k] : first[k + 1]])
            runs = np.diff(np.append(np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))), len(own)))
            fresh[k], top[k] = len(runs) / count[k], runs.max() / count[k]
            if count[k] > 1:
                two = words[first[k] : first[k + 1] - 1] * np.uint64(3) + words[first[k] + 1 : first[k + 1]]
                pairs[k] = len(distinct(two)) / (count[k] - 1)
        lines = np.bincount(owner[data == 0x0A], minlength=n) / many
        logs = np.log1p(np.stack((size, count), 1))
        out.append(
            np.column_stack((kinds, marks, logs, mean, np.sqrt(var), ending, odd, upper, repeated, fresh, top, pairs, lines))
        )
    return np.concatenate(out) if out else np.zeros((0, STATISTICS))


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return _features(x, self.centre, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def _features(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A constant, then cosines of fixed random projections."""
    rng = np.random.default_rng(SEED)
    turn = rng.normal(0, 1 / (WIDTH * np.sqrt(STATISTICS / 10)), (STATISTICS, COSINES))
    shift = rng.uniform(0, 2 * np.pi, COSINES)
    z = np.clip((x - centre) / scale, -8, 8)
    return np.column_stack((np.ones(len(x)), np.sqrt(2 / COSINES) * np.cos(z @ turn + shift)))


def monotone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the best rising step curve (pooled neighbours), each block by its first and last place."""
    places, where, n = np.unique(x, return_inverse=True, return_counts=True)
    sums = np.bincount(where, y, len(places))
    blocks: list[list[float]] = []  # first, last, sum, count
    for place, total, count in zip(places.tolist(), sums.tolist(), n.tolist(), strict=True):
        blocks.append([place, place, total, count])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, last, total, n = blocks.pop()
            blocks[-1][1] = last
            blocks[-1][2] += total
            blocks[-1][3] += n
    knots = [p for first, last, _, _ in blocks for p in ((first, last) if last > first else (first,))]
    levels = [s / n for first, last, s, n in blocks for _ in range(2 if last > first else 1)]
    return np.array(knots), np.array(levels)


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), STATISTICS)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Model | None:
    """A model of ``labels.quality`` from the training folds; None without rows of both classes."""
    ship(docs.sparkSession)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = statistics(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label"), batch.column("part"), pa.array([line.tobytes() for line in x], pa.binary())],
                    ["label", "part", "x"],
                )

    training = training_documents(docs, labels, "quality", most)
    part = fold(F.col("doc_id"), 20)  # 0, 5, 10 and 15 are held out
    table = written(
        training.select("label", part.alias("part"), "text").mapInArrow(vectors, "label int, part int, x binary"),
        "quality-training",
    )
    if table.select("label").distinct().count() < 2:
        return None
    learned = table.filter("part % 4 <> 1").repartition(PARTS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, STATISTICS))
        for batch in batches:
            x = _vectors(batch.column("x"))
            total += np.stack((np.full(STATISTICS, len(x)), x.sum(axis=0), (x * x).sum(axis=0)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    sums = [np.frombuffer(r["sums"]).reshape(3, -1) for r in learned.mapInArrow(moments, "sums binary").collect()]
    n, total, squares = np.sum(sums, axis=0)
    centre = total / np.maximum(n, 1)
    scale = np.sqrt(np.maximum(squares / np.maximum(n, 1) - centre**2, 0)) + 1e-3

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((COSINES + 1, COSINES + 2))
        for batch in batches:
            z = _features(_vectors(batch.column("x")), centre, scale)
            y = batch.column("label").to_numpy().astype(float)
            total += z.T @ np.column_stack((z, y))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    sums = [np.frombuffer(r["sums"]).reshape(COSINES + 1, -1) for r in learned.mapInArrow(equations, "sums binary").collect()]
    total = np.sum(sums, axis=0)
    weights = np.linalg.solve(total[:, :-1] + RIDGE * np.eye(COSINES + 1), total[:, -1])
    model = Model(centre, scale, weights, np.zeros(1), np.zeros(1))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.raw(_vectors(batch.column("x")))), batch.column("label")], ["raw", "label"]
            )

    unseen = table.filter("part % 4 = 1").mapInArrow(raw, "raw double, label int").toArrow()  # of ``most`` rows at most
    if not unseen.num_rows:
        unseen = table.mapInArrow(raw, "raw double, label int").toArrow()
    model.knots, model.levels = monotone(unseen["raw"].to_numpy(), unseen["label"].to_numpy().astype(float))
    return model


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if model is None:
        scored = rows.select("doc_id", F.lit(0.5).alias("score"))
    else:
        held = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = held.value.score(statistics(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

        scored = rows.mapInArrow(run, "doc_id long, score double")
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(), "score", predicted)
