"""Exact and near copies, components, repeated passages."""

import random

import duckdb
import numpy as np
import pytest
from conftest_llm import ODD, SCHEMA, near_groups, shingles, words
from pyspark.sql import functions as F

from strata.llm import exact_dedup, hyperminhash, near_dedup, substring_dedup
from strata.llm.components import components
from strata.llm.ship import documents
from strata.session import setting


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


COPY_COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_copies_equal_sql(spark, small):
    want = duckdb.sql(exact_dedup.SQL.replace("from documents", f"from '{small}/documents.parquet'"))
    order = [want.columns.index(c) for c in COPY_COLUMNS]
    assert rows(exact_dedup.exact_copies(documents(spark, small)), *COPY_COLUMNS) == sorted(
        (tuple(r[k] for k in order) for r in want.fetchall()), key=repr
    )


def test_exact_copies_of_odd_rows(odd, nothing):
    got = exact_dedup.exact_copies(odd).collect()
    assert len(got) == len(ODD)
    fox = [r for r in got if r.keep_id == 1 and r.group_size == 3]
    assert len(fox) == 3 and sorted(r.kept for r in fox) == [False, False, True]
    empty = [r for r in got if r.keep_id == 2]
    assert sorted((r.doc_id is None, r.kept) for r in empty) == [(False, False), (False, True), (True, False)]
    assert [r.kept for r in got if r.doc_id == 9] == [False]
    assert exact_dedup.exact_copies(nothing).count() == 0 and exact_dedup.drop_copies(nothing).count() == 0


def test_dropping_copies_keeps_every_column_and_one_row_of_each_text(odd):
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns and left.count() == len({t or "" for _, t, *_ in ODD})
    assert sorted(r.doc_id for r in left.collect() if r.text and "fox" in r.text) == [1, 1]


def test_hot_copies_are_cut_into_many_runs(spark):
    many = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'x ' || id, 'same  text') as text")
    got = exact_dedup.exact_copies(many)
    assert rows(got.filter("group_size > 1").groupBy("keep_id", "group_size").count(), "keep_id", "group_size", "count") == [(1, 2000, 2000)]
    assert got.filter("kept").count() == 1001


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_plain_search(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1060)]
    up = {x: x for pair in links for x in pair}
    for _ in up:  # to the fixed point
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert got == {x: c for x, c in up.items() if x in got} and {x for a, b in links if a != b for x in (a, b)} == set(got)


def test_no_links_no_components(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_links_of_several_chunks_become_one_result(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(200)] + [(1000 + rng.randrange(90), 1000 + rng.randrange(90)) for _ in range(60)]
    table = spark.createDataFrame(links, "a long, b long").repartition(3)
    want = rows(components(table), "node", "component")
    assert rows(components(table, most=7), "node", "component") == want
    assert dict(want)[200] == 0 and [c for n, c in want if n <= 200] == [0] * 201


def test_few_links_cost_the_driver_one_table(spark, monkeypatch):
    """A chain of links took three tables a round, whose plans stay in the driver; small partitions aren't always joined."""
    from strata.llm import components as module

    made = []
    write = module.written
    monkeypatch.setattr(module, "written", lambda df, label: made.append(label) or write(df, label))
    got = components(spark.createDataFrame([(k, k + 1) for k in range(500)], "a long, b long"))
    assert got.filter("component = 0").count() == 501 and len(made) == 1
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        got = components(spark.createDataFrame([(k, k + 1) for k in range(500)], "a long, b long"))
    assert got.filter("component = 0").count() == 501 and len(made) == 3


def family(seed, n, size, edits, base_id=0, noise=True):
    """Copies of a text, each with some words changed, drifting, so that links form chains; and other texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for k in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        if k % 7 == 3:
            base = text
        out.append((base_id + k, " ".join(text)))
    if noise:
        out += [(base_id + n + k, " ".join(f"n{rng.randrange(3000)}" for _ in range(rng.randrange(1, 60)))) for k in range(40)]
    return out


@pytest.mark.parametrize("block", [4, 512])
def test_near_components_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)  # small blocks: stars and bands of several
    texts = family(1, 60, 150, 9) + family(2, 50, 40, 3, 1000) + family(3, 40, 12, 2, 2000) + family(4, 30, 700, 60, 3000)
    texts += [(5000 + k, texts[k][1].upper()) for k in range(0, 150, 3)]
    random.Random(9).shuffle(texts)
    got = near_dedup.near_components(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    want = near_groups(texts)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == want[r.doc_id]) for r in got)
    sizes = dict(texts)
    assert all(r.n_shingles == len(shingles(sizes[r.doc_id])) for r in got)


def test_little_links_are_all_found_and_loose_texts_cost_nothing(spark, monkeypatch):
    """Links of three of four shingles, which bands may miss; and texts with a common frame, none of them near."""
    tried = []
    find = near_dedup._band_pairs

    def counted(*args):
        pairs = find(*args)
        tried.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_dedup, "_band_pairs", counted)
    frame = " ".join(f"frame{k}" for k in range(12))
    loose = [(k, f"{frame} " + " ".join(f"own{k}x{j}" for j in range(6))) for k in range(1500)]
    got = near_dedup.near_components(spark.createDataFrame(loose, "doc_id long, text string"))
    assert got.filter("kept").count() == 1500 and tried == [0, 0]
    little = [(2 * k, " ".join(f"w{k}x{j}" for j in range(8))) for k in range(2000)]
    little += [(2 * k + 1, " ".join(f"w{k}x{j}" for j in range(7))) for k in range(2000)]
    got = near_dedup.near_components(spark.createDataFrame(little + [(i + 5000, t) for i, t in loose], "doc_id long, text string"))
    assert got.filter("not kept").count() == 2000 and got.filter("component_id = doc_id - doc_id % 2 and doc_id < 4000").count() == 4000


def test_near_components_of_odd_rows(odd, nothing):
    got = near_dedup.near_components(odd)
    assert got.count() == len(ODD)
    found = sorted({(r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in got.collect()}, key=repr)
    by_id = {r[0]: r for r in found if r[0] != -1}
    assert by_id[6][2:] == (5, False) and by_id[5][2:] == (5, True) and by_id[9][2:] == (8, False)
    assert by_id[2] == (2, 0, 2, True) and by_id[4] == (4, 0, 4, True) and by_id[10] == (10, 1, 10, True)
    assert {r[1:] for r in found if r[0] == -1} == {(8, 1, False), (0, None, True)}
    assert near_dedup.near_components(nothing).count() == 0
    left = near_dedup.drop_near_copies(odd)
    assert left.columns == odd.columns and left.filter("doc_id in (6, 9)").count() == 0


def test_sketches_estimate_and_lose_no_close_set():
    rng = np.random.default_rng(1)
    errors, missed = [], 0
    for n in (8, 40, 300, 4000):
        for _ in range(40):
            both, only = int(n * 0.8), n - int(n * 0.8)
            draw = rng.integers(0, 2**64, both + only, dtype=np.uint64)
            a, b = np.sort(draw[: both + only // 2]), np.sort(np.concatenate((draw[:both], draw[both + only // 2 :])))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            lines = hyperminhash.registers([a, b])
            guess = hyperminhash.estimate((lines[0] == lines[1]).mean()[None], np.array([len(a)]), np.array([len(b)]))[0]
            errors.append((guess - true) / hyperminhash.spread(np.array([min(len(a), len(b))]))[0])
            keys = hyperminhash.bands(lines)
            missed += not (keys[0] == keys[1]).any()
    assert missed == 0 and np.abs(errors).max() < near_dedup.SURE
    far = hyperminhash.registers([np.sort(rng.integers(0, 2**64, 5000, dtype=np.uint64)) for _ in range(2)])
    agree = (far[0] == far[1]).mean()
    assert abs(hyperminhash.estimate(agree[None], np.array([5000]), np.array([5000]))[0]) < 0.02


# -- repeated passages ----------------------------------------------------------------------------------------


def sentences(text):
    """Lists of words, by the rule of the operator, for texts without long sentences."""
    out, own = [], []
    for line in (text or "").split("\n"):
        for w in words(line):
            own.append(w)
            if w[-1] in ".!?":
                out.append(own)
                own = []
        if own:
            out.append(own)
            own = []
    return out


def test_repeats_are_removed_but_the_first(spark):
    rng = random.Random(4)
    pool = [" ".join(f"s{rng.randrange(900)}" for _ in range(rng.randrange(1, 11))) + "." for _ in range(120)]
    passage = " ".join(pool[:8])
    docs = []
    for i in range(80):
        body = [rng.choice(pool[8:]) if rng.random() < 0.3 else " ".join(f"u{rng.randrange(10**6)}" for _ in range(6)) + "." for _ in range(rng.randrange(12))]
        if i % 9 == 4:
            body.insert(rng.randrange(len(body) + 1), passage)
        docs.append((i, ("\n" if i % 2 else " ").join(body)))
    seen, removed = {}, {}
    for i, text in docs:
        own = sentences(text)
        gone = set()
        for k in range(len(own)):
            end = k + min(3, len(own))
            while end < len(own) and sum(map(len, own[k:end])) < substring_dedup.LEAST_WORDS:
                end += 1
            run = [w for s in own[k:end] for w in s]
            if end <= len(own) and len(run) >= substring_dedup.LEAST_WORDS and seen.setdefault(tuple(run), (i, k)) != (i, k):
                gone.update(range(k, end))
        removed[i] = (len(own), len(gone), [w for k, s in enumerate(own) if k not in gone for w in s])
    got = substring_dedup.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_sentences, r.n_removed, words(r.text)) for r in got} == removed
    assert sum(r.n_removed > 0 for r in got) >= 8


def test_a_long_passage_without_sentence_ends_is_found(spark):
    rng = random.Random(8)
    plain = lambda n: " ".join(f"p{rng.randrange(10**6)}" for _ in range(n))
    passage = plain(90)
    docs = [(1, f"{plain(50)} {passage} {plain(33)}"), (2, f"{plain(21)} {passage} {plain(40)}"), (3, plain(150))]
    got = {r.doc_id: r for r in substring_dedup.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].n_removed == got[3].n_removed == 0
    left, own = set(words(got[2].text)), words(passage)
    assert sum(w in left for w in own) < len(own) / 2 and set(words(docs[1][1])) - set(own) <= left


@pytest.mark.parametrize("ends", [0, 1 / 20, 1 / 8])
def test_every_passage_of_51_words_in_mid_sentence_is_found(spark, ends):
    rng = random.Random(9)
    plain = lambda n: " ".join(f"w{rng.randrange(10**6)}{'.' if rng.random() < ends else ''}" for _ in range(n))
    passages = [plain(51 + k % 10) for k in range(300)]
    docs = [(2 * k + j, f"{plain(rng.randrange(40))} u{j} {p} v{j} {plain(rng.randrange(40))}") for k, p in enumerate(passages) for j in (0, 1)]
    got = {r.doc_id: r for r in substring_dedup.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, p in enumerate(passages):
        left, own = set(words(got[2 * k + 1].text)), words(p)
        assert got[2 * k].n_removed == 0
        assert sum(w not in left for w in own) >= substring_dedup.SPAN_WORDS or (ends and got[2 * k + 1].n_removed >= 3)
        assert set(words(docs[2 * k + 1][1])) - set(own) <= left


def test_different_texts_under_one_id_lose_only_what_repeats(spark):
    text = lambda c, n: " ".join(f"{c}{k} {c}x{k} {c}y{k} {c}z{k} {c}v{k}." for k in range(n))
    repeated = text("r", 9)
    docs = [(1, repeated), (2, f"{text('a', 30)} {repeated}"), (2, text("b", 5)), (3, text("c", 40)), (2, text("d", 4))]
    got = substring_dedup.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert sorted(r.text.strip() for r in got) == sorted([repeated, *(text(c, n) for c, n in zip("abcd", (30, 5, 40, 4)))])


def test_repeats_of_odd_rows(odd, nothing):
    got = substring_dedup.drop_repeats(odd)
    assert got.columns == [c for c in odd.columns if c != "n_sentences"] + ["n_sentences", "n_removed"]
    found = got.collect()
    assert len(found) == len(ODD) and sum(r.text is None for r in found) == 2
    assert next(r for r in found if r.doc_id == 6).n_removed > 29_000
    assert {r.n_removed for r in found if r.doc_id in (2, 3, 4, 5, 7, 8, 9, 10)} >= {0}
    assert substring_dedup.drop_repeats(nothing).count() == 0
    assert SCHEMA.split()[0] == got.columns[0]


# -- rows that share an id, columns without order ---------------------------------------------------------------


def test_texts_that_share_an_id_are_judged_apart(spark):
    one = " ".join(f"first{k}" for k in range(40))
    two = " ".join(f"second{k}" for k in range(40))
    three = " ".join(f"third{k}" for k in range(40))
    rows = [(2, one), (5, one + " end"), (5, two), (5, three), (3, two + " end"), (None, three + " end"), (None, "alone"), (9, "other"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__own", F.lit(1))
    left = {(r.doc_id, r.text) for r in near_dedup.drop_near_copies(docs).collect()}
    assert {(None, "alone"), (9, "other"), (9, None)} <= left and len(left) == 6
    for group in ([(2, one), (5, one + " end")], [(5, two), (3, two + " end")], [(5, three), (None, three + " end")]):
        assert len(left & set(group)) == 1


def test_exact_stage_takes_columns_without_order(spark):
    docs = spark.createDataFrame([(1, "a  b"), (1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    docs = docs.withColumns({"tags": F.create_map(F.lit("k"), F.col("doc_id")), "list": F.array(F.create_map(F.lit(1), F.lit(2)))})
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.tags) for r in left.collect()) == [(1, {"k": 1}), (3, {"k": 3})]
