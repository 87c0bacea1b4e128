"""Scores: language model, quality, toxicity."""

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD, words

from strata.llm import context_tree, lm_score, quality, toxicity
from strata.llm.ship import documents

SF = "/root/testdata/sf0.01"


def held(i, folds, value):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == value


# -- language model -------------------------------------------------------------------------------------------


def test_base_scores_equal_plain_counting(spark, small):
    rows = [tuple(r) for r in documents(spark, small).select("doc_id", "text").collect()]
    count = Counter()
    for i, t in rows:
        if not held(i, 7, 2):
            count.update([*words(t), "\0end"])
    total, distinct = sum(count.values()), len(count)
    got = {r.doc_id: r for r in lm_score.score_documents(documents(spark, small)).collect()}
    for i, t in rows:
        own, r = [*words(t), "\0end"], got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in count for w in own), total)
        assert r.held_out == held(i, 7, 2)
        want = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in own)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert r.score < 0


def log_estimate(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class PlainTree:
    """The weighting by its definition, over dictionaries."""

    def __init__(self, texts):
        self.n = [defaultdict(lambda: [0, 0]) for _ in range(context_tree.DEPTH + 1)]
        for text in texts:
            for context, byte in self.positions(text):
                for level in range(8):
                    prefix, bit = (1 << level) | (byte >> (8 - level)), (byte >> (7 - level)) & 1
                    for d in range(context_tree.DEPTH + 1):
                        self.n[d][context[:d], prefix][bit] += 1
        self.weighted, self.stop = {}, {}
        for d in range(context_tree.DEPTH, -1, -1):
            split = defaultdict(float)
            for (c, p), w in ((k[1], v) for k, v in self.weighted.items() if k[0] == d + 1):
                split[c[:d], p] += w
            for (c, p), (a, b) in self.n[d].items():
                own = log_estimate(a, b)
                total = own if d == context_tree.DEPTH else np.logaddexp(own, split[c, p]) - math.log(2)
                self.weighted[d, (c, p)] = total
                self.stop[d, (c, p)] = 1.0 if d == context_tree.DEPTH else math.exp(own - math.log(2) - total)

    @staticmethod
    def positions(text):
        data = bytes([context_tree.END] * context_tree.DEPTH) + text + bytes([context_tree.END])
        for k in range(context_tree.DEPTH, len(data)):
            yield tuple(data[k - d] for d in range(1, context_tree.DEPTH + 1)), data[k]

    def score(self, text):
        total = 0.0
        for context, byte in self.positions(text):
            for level in range(8):
                prefix, bit = (1 << level) | (byte >> (8 - level)), (byte >> (7 - level)) & 1
                mixed = None
                for d in range(context_tree.DEPTH, -1, -1):
                    if (key := (context[:d], prefix)) in self.n[d]:
                        a, b = self.n[d][key]
                        own = (b + 0.5) / (a + b + 1)
                        stop = self.stop[d, key]
                        mixed = own if mixed is None else stop * own + (1 - stop) * mixed
                mixed = 0.5 if mixed is None else mixed
                total += math.log10(mixed if bit else 1 - mixed)
        return total


def test_code_lengths_equal_the_definition(spark):
    texts = ["abracadabra", "abra abra cadabra", "", "ça va ça va", "abracadabra", None, "zzzzzz"]
    docs = [(k, t) for k, t in enumerate(texts * 2)]
    plain = PlainTree([(t or "").encode() for i, t in docs if not held(i, 7, 2)])
    got = {r.doc_id: r.score for r in lm_score.score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        # probabilities are kept in 65536ths
        assert got[i] == pytest.approx(plain.score((t or "").encode()), rel=2e-3, abs=2e-3)


def test_next_byte_probabilities_sum_to_one(spark):
    keys, n = np.unique(context_tree.grams(np.frombuffer(b"the cat sat on the mat", np.uint8), np.array([0, 22]))[0], return_counts=True)
    counts = spark.createDataFrame([(int(k), int(c)) for k, c in zip(keys, n)], "key long, n long")
    tree = context_tree.tree(counts)
    for context in (keys[3] >> np.uint64(8), np.uint64(0x6161616161)):
        every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert (10 ** tree.bits(every)).sum() == pytest.approx(1, abs=1e-9)
        scorer = context_tree.Scorer(tree)
        assert np.allclose(scorer(np.concatenate((every, every))), np.tile(tree.bits(every), 2), rtol=1e-6)
        assert np.allclose(scorer(every), tree.bits(every), rtol=1e-6)


def test_no_context_is_dropped_from_a_large_tree(spark, monkeypatch):
    rng = np.random.default_rng(5)
    signs = np.frombuffer(bytes(range(48, 112)), np.uint8)
    docs = [(k, signs[rng.integers(0, 64, 2500)].tobytes().decode()) for k in range(24)]
    docs += [(24 + k, docs[k][1][1000:2000] + "é") for k in range(8)]
    plain = PlainTree([t.encode() for i, t in docs if not held(i, 7, 2)])
    assert sum(map(len, plain.n)) > 800_000
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    for runs in (context_tree.CHUNK_RUNS, 9000):  # one chunk, and several
        monkeypatch.setattr(context_tree, "CHUNK_RUNS", runs)
        got = {r.doc_id: r.score for r in lm_score.score_documents(rows).collect()}
        for i, t in docs:
            assert got[i] == pytest.approx(plain.score(t.encode()), rel=1e-6)


def test_packed_runs_come_back():
    keys = np.array([0, 1, 255, 256, 1 << 33, (1 << 48) - 1], np.uint64)
    assert (context_tree.unpacked(context_tree.packed(keys)) == keys).all()
    assert len(context_tree.unpacked(context_tree.packed(keys[:0]))) == 0


def test_held_out_texts_code_shorter_than_by_word_frequencies(spark):
    r = [r for r in lm_score.score_documents(documents(spark, "/root/testdata/sf0.1")).collect() if r.held_out]
    assert sum(x.score for x in r) > sum(x.base_score for x in r)


def test_language_model_of_odd_rows(odd, nothing):
    got = lm_score.score_documents(odd).collect()
    assert len(got) == len(ODD)
    assert {(r.n_tokens, r.score < 0) for r in got if r.doc_id in (2, 3)} == {(1, True)}
    fox = [(r.n_tokens, r.base_score, r.score) for r in got if r.doc_id == 1 and r.n_tokens == 13]
    assert len(fox) == 3 and len({f[1] for f in fox}) == 1
    assert lm_score.score_documents(nothing).count() == 0


# -- classifiers ----------------------------------------------------------------------------------------------


def right(spark, fn, label, sf=SF):
    known = spark.read.parquet(f"{sf}/labels.parquet")
    labels = {r.doc_id: r[label] for r in known.collect()}
    rows = [r for r in fn(documents(spark, sf), known).select("doc_id", "held_out", "score", "predicted").collect() if r.doc_id in labels]
    assert all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in rows)
    return [(r, labels[r.doc_id]) for r in rows if r.held_out]


def test_quality_on_held_out_labels(spark):
    found = right(spark, quality.score_quality, "quality")
    assert all(r.predicted == (r.score >= 0.3) for r, _ in found)
    assert np.mean([r.predicted == y for r, y in found]) > 0.97


def test_toxicity_on_held_out_labels(spark):
    found = right(spark, toxicity.score_toxicity, "toxic", "/root/testdata/sf0.1")
    assert all(r.predicted == (r.score >= 0.5) for r, _ in found)
    assert np.mean([r.predicted == y for r, y in found]) > 0.96
    assert np.mean([r.predicted for r, y in found if not y]) < 0.02
    assert np.mean([r.predicted for r, y in found if y]) > 0.8


@pytest.mark.parametrize("fn, label", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_classifiers_of_odd_rows(spark, odd, nothing, some_labels, fn, label):
    for labels in (some_labels, some_labels.limit(0), spark.read.parquet(f"{SF}/labels.parquet")):
        got = fn(odd, labels).select("doc_id", "held_out", "score", "predicted").collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert fn(nothing, labels).count() == 0
    twice = [r.score for r in got if r.doc_id in (8, 9)]
    assert twice[0] == twice[1]
    assert toxicity.drop_toxic(odd, some_labels).columns == odd.columns


def test_rising_curve_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        x, y = rng.integers(0, 8, 9).astype(float), rng.integers(0, 2, 9).astype(float)
        knots, levels = quality.monotone(x, y)
        assert (np.diff(levels) >= 0).all() and (np.diff(knots) > 0).all()
        loss = ((np.interp(x, knots, levels) - y) ** 2).sum()
        places = np.unique(x)
        grid = sorted({y[np.isin(x, places[a:b])].mean() for a in range(len(places)) for b in range(a + 1, len(places) + 1)})
        best = min(
            sum(((y[x == p] - v) ** 2).sum() for p, v in zip(places, curve))
            for curve in itertools.combinations_with_replacement(grid, len(places))
        ) if len(grid) ** 1 < 40 and len(places) <= 5 else loss
        assert loss <= best + 1e-9


def test_maximal_segments_equal_the_definition():
    rng = np.random.default_rng(3)

    def by_definition(s, offset=0):
        """The best segment, then the same on both sides of it."""
        total = np.concatenate(([0.0], np.cumsum(s)))
        best, at = 0.0, None
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                gain = total[b] - total[a]
                if gain > best + 1e-12 or (at and abs(gain - best) <= 1e-12 and b - a < at[1] - at[0]):
                    best, at = gain, (a, b)
        if at is None:
            return []
        a, b = at
        return by_definition(s[:a], offset) + [(offset + a, offset + b - 1, best)] + by_definition(s[b:], offset + b)

    for _ in range(150):
        s = np.round(rng.normal(-0.2, 1, rng.integers(0, 30)), 3)
        got = toxicity.segments(s)
        want = by_definition(s)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_segments_of_many_falling_parts_take_linear_time():
    import time

    s = np.tile([1.0, -2.0], 200_000)
    start = time.process_time()
    assert len(toxicity.segments(s)) == 200_000
    assert time.process_time() - start < 5


def test_statistics_have_one_row_for_each_text():
    texts = [t for _, t, *_ in ODD]
    x = quality.statistics(pa.array(texts, pa.string()))
    assert x.shape == (len(texts), quality.STATISTICS) and np.isfinite(x).all() and (x[3] == 0).all()
