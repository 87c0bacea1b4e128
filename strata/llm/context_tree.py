"""Context-tree weighting over bytes: a code length for every text, from counts of the whole training corpus.

A text is its UTF-8 bytes and an end mark. Each byte is eight binary decisions; a decision at a node (the bits before
it in the byte) is predicted in the context of the last 0 to ``DEPTH`` bytes, by the Krichevsky-Trofimov estimate of that
context's counts. Contexts form a tree; a node's weighted probability of its training bits is half its own estimate's and
half the product of its children's, so the share of each depth in a prediction is its posterior after the training.
Where the tree has no child for a context, the node's own estimate stands.

Training: tasks count the distinct runs of ``DEPTH`` + 1 bytes and Spark adds them up. A run begins with its latest context
byte, so runs in order have every context's runs side by side. Runs are dealt by their first ``SPLIT`` bytes; what lies
below such a context is at most 256^3 runs, whatever the corpus, and is weighted in one pass over the sorted runs. The
contexts above it are at most 256^2 of 255 nodes each, and are weighted from the sums of those below. No node is dropped.

Scoring: every distinct run of the corpus, trained or not, is scored once where its nodes are. Documents are dealt to chunks
of about ``CHUNK_RUNS`` runs; a chunk asks for each of its distinct runs once and is sent the scores. Both are packed by
buckets of the run's hash, so that what moves are a few arrays, of a volume that follows the corpus.

Rows: null text counts as empty: only the end mark is coded. Repeated rows are counted and scored each. An empty table
gives no rows; with no training rows every bit has the probability one half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import mix

DEPTH = 5
END = 0xFF  # never a byte of UTF-8
SPLIT = 3
CHUNK_RUNS = 1 << 25
HELD_GRAMS = 2_000_000
MEMO_BITS = 22
PREFIX = np.uint64(8)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The run of bytes at every position of every row, end marks included, and where each row begins in them.

    The latest context byte is the highest, the byte itself the lowest.
    """
    rows, size = len(offsets) - 1, np.diff(offsets)
    padded = np.full(len(data) + DEPTH * (rows + 1), END, np.uint8)
    shift = np.repeat(DEPTH * np.arange(1, rows + 1), size)
    padded[np.arange(len(data)) + shift] = data
    out = np.zeros(len(padded) - DEPTH, np.uint64)
    for d in range(1, DEPTH + 1):
        out = (out << PREFIX) | padded[DEPTH - d : len(padded) - d]
    out = (out << PREFIX) | padded[DEPTH:]
    real = np.zeros(len(out) + 1, np.int8)  # a row and its mark, then DEPTH - 1 marks that only pad
    begins = offsets[:-1] + DEPTH * np.arange(rows)
    real[begins] += 1
    np.subtract.at(real, begins + size + 1, 1)
    return out[np.cumsum(real[:-1]) > 0], offsets + np.arange(rows + 1)


class GramCounts:
    """Counts of distinct runs, sorted, merged as they come."""

    def __init__(self):
        self.waiting, self.n = [], 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.n += len(keys)
        if self.n >= HELD_GRAMS:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            keys = np.sort(np.concatenate(self.waiting))
            at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            counts = np.diff(np.append(at, len(keys)))
            keys = np.concatenate((self.keys, keys[at]))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], np.concatenate((self.counts, counts))[order]
            at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.keys, self.counts = keys[at], np.add.reduceat(counts, at)
            self.waiting, self.n = [], 0


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 0.5: Stirling's series at x + 6, brought back by the recurrence."""
    z = x + 6
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + series - np.log(steps)


def _estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of the counts."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def _parent(node: np.ndarray) -> np.ndarray:
    """The same bits after a context that is one byte shorter; also of runs."""
    return ((node >> np.uint64(16)) << PREFIX) | (node & np.uint64(255))


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their values."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], *(np.add.reduceat(v[order], at) for v in values)


class Nodes(NamedTuple):
    """Nodes of one depth and one bit, in order."""

    node: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    weighted: np.ndarray  # logarithm
    stop: np.ndarray  # share of the node's own estimate


def _weigh(node: np.ndarray, n0: np.ndarray, n1: np.ndarray, split: np.ndarray | None) -> Nodes:
    own = _estimate(n0, n1)
    if split is None:
        return Nodes(node, n0, n1, own, np.ones(len(node)))
    ahead = np.logaddexp(own, split)
    return Nodes(node, n0, n1, ahead - np.log(2), np.exp(own - ahead))


def grow(keys: np.ndarray, n: np.ndarray, top: int) -> dict[int, list[Nodes]]:
    """For each depth from the deepest to ``top``: nodes of each bit, from sorted distinct runs and their counts."""
    out: dict[int, list[Nodes]] = {}
    for depth in range(DEPTH, top - 1, -1):
        if depth < DEPTH:
            keys, n = _sums(_parent(keys), n)
        low, out[depth] = keys & np.uint64(255), []
        for level in range(8):
            node = ((keys >> PREFIX) << PREFIX) | np.uint64(1 << level) | (low >> np.uint64(8 - level))
            ones = np.where((low >> np.uint64(7 - level)) & np.uint64(1) == 1, n, 0)
            node, total, ones = _sums(node, n, ones)
            split = None
            if depth < DEPTH:
                below = out[depth + 1][level]
                split = np.bincount(np.searchsorted(node, _parent(below.node)), below.weighted, len(node))
            out[depth].append(_weigh(node, total - ones, ones, split))
    return out


class Shares(NamedTuple):
    """What predictions at nodes of one depth and one bit, in order, are made of."""

    node: np.ndarray
    one: np.ndarray  # probability of a set bit where no deeper node is known
    spent: np.ndarray  # part of it that is settled by the node and those above
    left: np.ndarray  # share of the deeper ones


def shares(nodes: dict[int, list[Nodes]], above: dict[int, list[Shares]]) -> dict[int, list[Shares]]:
    """The same nodes ready to predict; those of the depth before the first are ``above``."""
    out = dict(above)
    for depth in sorted(nodes):
        out[depth] = []
        for level, (node, n0, n1, _, stop) in enumerate(nodes[depth]):
            own = (n1 + 0.5) / (n0 + n1 + 1)
            spent, left = np.zeros(len(node)), np.ones(len(node))
            if depth:
                up = out[depth - 1][level]
                at = np.searchsorted(up.node, _parent(node))
                spent, left = up.spent[at], up.left[at]
            out[depth].append(Shares(node, spent + left * own, spent + left * stop * own, left * (1 - stop)))
    return out


@dataclass
class Tree:
    nodes: dict[int, list[Shares]]  # by depth, then by bit

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each run's last byte after the others."""
        total = np.zeros(len(keys))
        low = keys & np.uint64(255)
        for level in range(8):
            prefix = np.uint64(1 << level) | (low >> np.uint64(8 - level))
            mixed, open_ = np.full(len(keys), 0.5), np.arange(len(keys))
            for depth in range(DEPTH, -1, -1):
                known = self.nodes[depth][level]
                if not len(known.node) or not len(open_):
                    continue
                node = ((keys[open_] >> np.uint64(8 + 8 * (DEPTH - depth))) << PREFIX) | prefix[open_]
                at = np.minimum(np.searchsorted(known.node, node), len(known.node) - 1)
                here = known.node[at] == node
                mixed[open_[here]] = known.one[at[here]]
                open_ = open_[~here]
            one = (low >> np.uint64(7 - level)) & np.uint64(1)
            total += np.log10(np.where(one == 1, mixed, 1 - mixed))
        return total


@dataclass
class Known:
    """Scores of some runs, in order."""

    keys: np.ndarray
    scores: np.ndarray

    def bits(self, keys: np.ndarray) -> np.ndarray:
        return self.scores[np.searchsorted(self.keys, keys)]


class Scorer:
    """Scores runs by a tree or by known scores, remembering results in a table of a fixed size."""

    def __init__(self, tree: Tree | Known):
        self.tree = tree
        self.keys = np.full(1 << MEMO_BITS, 1 << 63, np.uint64)
        self.values = np.zeros(1 << MEMO_BITS, np.float32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        out = self.values[at]
        new = np.flatnonzero(self.keys[at] != keys)
        if len(new):
            fresh, where = np.unique(keys[new], return_inverse=True)
            found = self.tree.bits(fresh).astype(np.float32)
            out[new] = found[where]
            at = ((fresh * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
            self.keys[at], self.values[at] = fresh, found
            last = self.keys[at] == fresh  # of runs that share a place the last one written holds both arrays
            self.values[at[last]] = found[last]
        return out


def _by_context(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted runs and counts, whole contexts of ``SPLIT`` bytes at a time."""
    held, size = [], 0
    for batch in batches:
        held.append((batch.column("key").to_numpy().astype(np.uint64), batch.column("n").to_numpy()))
        size += len(batch)
        if size >= HELD_GRAMS:
            keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
            context = keys >> np.uint64(8 * (DEPTH + 1 - SPLIT))
            cut = int(np.searchsorted(context, context[-1]))
            held, size = [(keys[cut:], n[cut:])], len(keys) - cut
            if cut:
                yield keys[:cut], n[:cut]
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def upper(sorted_counts: DataFrame) -> dict[int, list[Shares]]:
    """The contexts of less than ``SPLIT`` bytes: a bounded number."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _by_context(batches):
            for x in grow(keys[n > 0], n[n > 0], SPLIT)[SPLIT]:
                found = _sums(_parent(x.node), x.n0, x.n1, x.weighted)
                for k in range(0, len(found[0]), 1 << 16):
                    node, *values = (v[k : k + (1 << 16)] for v in found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node.astype(np.int64)), *map(pa.array, values)], ["node", "n0", "n1", "split"]
                    )

    added = sorted_counts.mapInArrow(sums, "node long, n0 long, n1 long, split double").groupBy("node")
    table = added.agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "split"))).orderBy("node").toArrow()
    node, n0, n1, split = (table[c].to_numpy() for c in ("node", "n0", "n1", "split"))
    node = node.astype(np.uint64)
    bit = np.frexp((node & np.uint64(255)).astype(float))[1] - 1
    nodes: dict[int, list[Nodes]] = {SPLIT - 1: [_weigh(*(v[bit == k] for v in (node, n0, n1, split))) for k in range(8)]}
    for depth in range(SPLIT - 2, -1, -1):
        nodes[depth] = [_weigh(*_sums(_parent(x.node), x.n0, x.n1, x.weighted)) for x in nodes[depth + 1]]
    return shares(nodes, {})


def by_context(counts: DataFrame) -> DataFrame:
    """``counts`` (key, n) dealt and sorted for ``upper`` and ``run_scores``."""
    context = F.shiftright("key", 8 * (DEPTH + 1 - SPLIT))
    return counts.select("key", "n").repartition(context).sortWithinPartitions("key")


def in_buckets(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts sorted runs by bucket, and where each bucket begins and ends in it."""
    bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    return np.argsort(bucket, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=buckets))))


def packed(keys: np.ndarray) -> bytes:
    """Sorted runs as differences, byte by byte, so that they compress."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, : DEPTH + 1].T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    steps = np.zeros((len(raw) // (DEPTH + 1), 8), np.uint8)
    steps[:, : DEPTH + 1] = np.frombuffer(raw, np.uint8).reshape(DEPTH + 1, -1).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def run_scores(sorted_counts: DataFrame, buckets: int) -> DataFrame:
    """Scores of all runs, also those with a count of 0: bucket, runs, scores (packed)."""
    above = sorted_counts.sparkSession.sparkContext.broadcast(upper(sorted_counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _by_context(batches):
            model = Tree(shares(grow(keys[n > 0], n[n > 0], SPLIT), above.value))
            found = model.bits(keys).astype("<f4")
            order, edge = in_buckets(keys, buckets)
            for k in np.flatnonzero(np.diff(edge)):
                part = order[edge[k] : edge[k + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(k)]), pa.array([packed(keys[part])]), pa.array([found[part].tobytes()])],
                    ["bucket", "runs", "scores"],
                )

    return sorted_counts.mapInArrow(run, "bucket long, runs binary, scores binary")


def distinct_runs(texts: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    held = GramCounts()
    for data, offsets in texts:
        held.add(grams(data, offsets)[0])
    held.settle()
    return held.keys


def answered(scores: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (chunk, bucket, runs) with the scores of its runs in their place."""

    def look_up(known: pa.Table, asked: pa.Table) -> pa.Table:
        keys = np.concatenate([np.zeros(0, np.uint64), *(unpacked(r) for r in known["runs"].to_pylist())])
        found = np.concatenate([np.zeros(0, "<f4"), *(np.frombuffer(r, "<f4") for r in known["scores"].to_pylist())])
        order = np.argsort(keys)
        model = Known(keys[order], found[order])
        out = [model.bits(unpacked(r)).tobytes() for r in asked["runs"].to_pylist()]
        return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"], "scores": pa.array(out, pa.binary())})

    both = scores.groupBy("bucket").cogroup(asked.groupBy("bucket"))
    return both.applyInArrow(look_up, "chunk long, bucket long, scores binary")


def tree(counts: DataFrame) -> Tree:
    """The whole tree in one place, of a corpus that is small enough for that; ``counts`` has key, n."""
    found = counts.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 0").orderBy("key").toArrow()
    return Tree(shares(grow(found["key"].to_numpy().astype(np.uint64), found["n"].to_numpy(), 0), {}))
