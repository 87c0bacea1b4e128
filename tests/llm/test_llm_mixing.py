"""Mixing, fingerprints, and the pipeline as a whole."""

import hashlib

import duckdb
import numpy as np
import pytest
from conftest_llm import ODD, near_groups

import corpus_pipeline
from strata.llm import fingerprint, mixing, near_dedup, toxicity
from strata.llm.ship import documents

COLUMNS = ("doc_id", "source", "n_tokens", "exponent", "weight", "budget_tokens", "copies")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_mixture_equals_sql(spark, small):
    want = duckdb.sql(mixing.SQL.replace("from documents", f"from '{small}/documents.parquet'"))
    order = [want.columns.index(c) for c in COLUMNS]
    got = rows(mixing.mixture(documents(spark, small)), *COLUMNS)
    assert got == sorted((tuple(r[k] for k in order) for r in want.fetchall()), key=repr)
    mixed = mixing.mixed(documents(spark, small))
    assert mixed.columns == documents(spark, small).columns
    assert dict(rows(mixed.groupBy("doc_id").count(), "doc_id", "count")) == {r[0]: r[6] for r in got}


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(4000).selectExpr(
        "id as doc_id", "repeat('w ', int(1 + id % 7)) as text", "if(id % 10 < 7, 'big', if(id % 10 = 7, 'mid', 's' || (id % 100))) as source"
    )


def test_budgets_are_kept_and_blocks_don_t_change_the_choice(skewed, monkeypatch):
    chosen = []
    for block in (50, 4096):
        monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
        got = mixing.mixture(skewed, repetition_limit=3.0).collect()
        by = {}
        for r in got:
            by.setdefault((r.source, r.budget_tokens), []).append(r.n_tokens * r.copies)
            assert 1 <= r.copies <= 3
        assert all(budget - 7 < sum(v) <= budget for (_, budget), v in by.items())
        assert 0 < got[0].exponent < 1 and max(budget for _, budget in by) and by
        chosen.append(sorted((r.doc_id, r.copies) for r in got))
    assert chosen[0] == chosen[1]


def test_entropy_and_given_budget(skewed):
    got = mixing.mixture(skewed, repetition_limit=None, entropy=2.5, budget=9000)
    weight = dict(rows(got.select("source", "weight").distinct(), "source", "weight"))
    w = np.array(list(weight.values()))
    assert -(w * np.log2(w)).sum() == pytest.approx(2.5, abs=1e-3) and w.sum() == pytest.approx(1, abs=1e-4)
    taken = got.selectExpr("sum(n_tokens * copies) as n").first().n
    assert 9000 - 7 * len(w) < taken <= 9000 + len(w)


def test_mixture_of_odd_rows(odd, nothing):
    got = mixing.mixture(odd)
    assert got.count() == len(ODD) and got.filter("copies < 1").count() == 0
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mixture(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


# -- fingerprints ---------------------------------------------------------------------------------------------


def grams(text):
    b = text.encode()
    return {b[k : k + fingerprint.WIDTH] for k in range(len(b) - fingerprint.WIDTH + 1)} or ({b} if b else set())


@pytest.mark.parametrize("buckets", [1, 5, None])
def test_edited_texts_and_neighbours(spark, small, buckets):
    rows_ = sorted(map(tuple, documents(spark, small).select("doc_id", "text").collect()))
    got = {r.doc_id: r for r in fingerprint.edited_likeness(documents(spark, small), buckets).collect()}
    assert len(got) == len(rows_)
    errors = []
    for k, (i, text) in enumerate(rows_):
        following, cut, r = rows_[(k + 1) % len(rows_)][1], len(text) // 4, got[i]
        edited = text[: len(text) - cut] + following[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = grams(text), grams(edited), grams(following)
        errors += [r.near_edited - len(a & b) / len(a | b), r.near_next - len(a & c) / len(a | c)]
    assert np.std(errors) < 0.05 and abs(np.mean(errors)) < 0.01


def test_sketches_retain_compare_and_merge():
    rng = np.random.default_rng(6)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    small, large = word(200), word(40_000)
    texts = [small, large, large + small, b"", b"abc", word(9)]
    found = fingerprint.sketches(texts)
    assert [s for s, _ in found] == [1, fingerprint.SCALE, fingerprint.SCALE, 1, 1, 1]
    for s in found:
        back = fingerprint.from_text(fingerprint.as_text(s))
        assert back[0] == s[0] and back[1].tolist() == s[1].tolist()
    assert fingerprint.containment(found[0], found[2]) > 0.8 and fingerprint.containment(found[0], found[1]) < 0.2
    assert fingerprint.likeness(found[3], found[3]) == 1 and fingerprint.likeness(found[3], found[4]) == 0
    merged = fingerprint.merge(found[0], found[1])
    assert fingerprint.likeness(merged, found[2]) > 0.98
    assert len(found[1][1]) == pytest.approx(40_000 / fingerprint.SCALE, rel=0.1)


def test_fingerprints_of_odd_rows(spark, odd, nothing):
    got = fingerprint.edited_likeness(odd, 3).collect()
    assert len(got) == len(ODD) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = {r.fingerprint for r in got if r.doc_id in (8, 9)}
    assert len(same) == 1
    plain = fingerprint.fingerprints(odd)
    assert plain.columns == [*odd.columns, "fingerprint"] and plain.count() == len(ODD)
    one = fingerprint.edited_likeness(spark.createDataFrame([(3, "only this text")], "doc_id long, text string")).collect()
    assert [(r.near_next, r.n_chars) for r in one] == [(1.0, 14)]
    assert fingerprint.edited_likeness(nothing).count() == 0


# -- pipeline -------------------------------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark, small):
    docs, labels = documents(spark, small), spark.read.parquet(f"{small}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, labels).filter("predicted = 1").collect()}
    left = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic)
    assert 0 < len(toxic) < len(left) / 5
    first = {}
    for i, t in left:
        first.setdefault(" ".join(t.replace("\t", " ").replace("\n", " ").split(" ")), i)
    exact = [(i, t) for i, t in left if i in set(first.values())]
    group = near_groups(exact)
    kept = [(i, t) for i, t in exact if group[i] == i]
    assert len(left) > len(exact) >= len(kept)
    again = mixing.mixture(docs.filter(docs.doc_id.isin([i for i, _ in kept])))
    copies = dict(rows(again, "doc_id", "copies"))
    tokens = {i: n for i, n in rows(corpus_pipeline.packing(spark, docs, small).select("doc_id", "doc_tokens").distinct(), "doc_id", "doc_tokens")}
    got = corpus_pipeline.run(spark, small)
    total = dict(rows(got.groupBy("doc_id").sum("length"), "doc_id", "sum(length)"))
    assert total == {i: tokens[i] * copies[i] for i, _ in kept}
    filled = rows(got.groupBy("sequence_id").sum("length"), "sum(length)")
    assert all(n == 2048 or n & (n - 1) == 0 for (n,) in filled)


def test_pipeline_stages_keep_the_columns(spark, odd, tmp_path):
    odd.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark, str(tmp_path))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = near_dedup.written(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
