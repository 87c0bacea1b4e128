"""Words, token files and packing against the plain libraries."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import LONG, ODD, shingles, words
from pyspark.sql import functions as F

from strata.llm import packing, token_files, tokens
from strata.llm.ship import documents
from strata.llm.text import distinct, shingle_hashes, slices, word_hashes

TEXTS = [t for _, t, *_ in ODD] + ["x " * 70_000, "B" * 1_200_000, "Ünï cöde\x85y", "a\x0bb\x0cc", "don't I'LL \r\n\r\n we're  so"]


def test_words_and_shingles_are_known_by_their_hashes():
    seen, n_words, n_shingles = {}, [], []
    for row, end, data, offsets in slices(pa.array(TEXTS, pa.string())):
        hashes, first = word_hashes(data, offsets)
        found, bounds = shingle_hashes(hashes, first)
        for k in range(row, end):
            own = words(TEXTS[k])
            assert len(own) == first[k - row + 1] - first[k - row]
            for w, h in zip(own, hashes[first[k - row] :].tolist()):
                assert seen.setdefault(w, h) == h
            n_words.append(len(own))
            assert len(distinct(found[bounds[k - row] : bounds[k - row + 1]])) == len(shingles(TEXTS[k]))
            n_shingles.append(k)
    assert n_shingles == list(range(len(TEXTS))) and len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_gives_the_ids_of_the_tokenizer(name, monkeypatch):
    from tokenizers import Tokenizer

    path = tokens.tokenizer_path(name)
    plain = Tokenizer.from_file(path)
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    monkeypatch.setattr(tokens, "STORE_PIECES", 20)  # the store starts afresh again and again
    monkeypatch.setattr(tokens, "SLICE_BYTES", 100)
    for coder in (tokens.Encoder(path),):
        for _ in range(2):
            ids, bounds = coder.encode(pa.array(TEXTS, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want
    assert coder.encode(pa.array([], pa.string()))[0].tolist() == []


def encoded(rows, name):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.tokenizer_path(name))
    return [np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for _, t in rows]


def test_token_files_are_an_exact_round_trip(spark, small, tmp_path):
    folder = str(tmp_path / "ids")
    docs = documents(spark, small)
    token_files.write_token_files(docs, folder, tokens.tokenizer_path("word_bpe_49k.json"))
    got = [tuple(r) for r in token_files.read_token_files(spark, folder).orderBy("start").collect()]
    rows = sorted(map(tuple, docs.select("doc_id", "text").collect()))
    at = 0
    for (doc_id, start, raw), (want_id, _), ids in zip(got, rows, encoded(rows, "word_bpe_49k.json"), strict=True):
        assert (doc_id, start, bytes(raw)) == (want_id, at, ids.tobytes())
        at += len(ids)
    manifest = token_files.read_manifest(spark, folder).orderBy("shard").collect()
    assert [r.base for r in manifest] == np.cumsum([0, *[r.tokens for r in manifest]])[:-1].tolist()


def test_token_files_of_odd_rows_and_of_nothing(spark, odd, nothing, tmp_path):
    path = tokens.tokenizer_path("word_bpe_49k.json")
    token_files.write_token_files(odd, str(tmp_path / "odd"), path)
    got = token_files.read_token_files(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in got][:2] == [None, None] and sorted(r.doc_id for r in got[2:]) == [r.doc_id for r in got[2:]]
    want = {(r[0], e.tobytes()) for r, e in zip(ODD, encoded([(r[0], r[1]) for r in ODD], "word_bpe_49k.json"))}
    assert {(r.doc_id, bytes(r.ids)) for r in got} == want and len(got) == len(ODD)
    token_files.write_token_files(nothing, str(tmp_path / "none"), path)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("lengths", [[1], [2048], [5000, 1, 1, 7], [100] * 77, [2047, 2, 2047, 3, 9000], list(range(1, 400))])
def test_packing_cuts_and_fills_exactly(lengths):
    pieces = packing.pack(np.array(lengths), 2048, 1.0, 1 / 2048)
    by_row, by_sequence = {}, {}
    for row, start, n, sequence, offset in pieces:
        by_row.setdefault(row, []).append((start, n))
        by_sequence.setdefault(sequence, []).append((offset, n))
    for row, n in enumerate(lengths):
        at = 0
        for start, size in sorted(by_row[row]):
            assert start == at and size > 0
            at += size
        assert at == n
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 2048 or at & (at - 1) == 0  # never padded


def test_packing_balances_cost():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 2000, 800)
    cost = {}
    for _, _, n, s, _ in packing.pack(lengths, 2048, 1.0, 1 / 2048):
        cost[s] = cost.get(s, 0) + n + n * n / 2048
    whole = [c for s, c in cost.items()]
    first_fit, sums = [], []
    for n in lengths:  # as they come, without a look at cost
        if not sums or sums[-1] + n > 2048:
            sums.append(0)
            first_fit.append(0.0)
        sums[-1] += n
        first_fit[-1] += n + n * n / 2048
    assert np.std(sorted(whole)[10:]) < np.std(first_fit)


def test_packing_of_documents(spark, odd, nothing):
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    got = packing.pack_documents(odd, path, cell_rows=4).collect()
    want = [(r[0], e) for r, e in zip(ODD, encoded([(r[0], r[1]) for r in ODD], "byte_bpe_50k.json"))]
    assert sum(r.length for r in got) == sum(len(e) for _, e in want)
    starts = sorted((r.doc_id or 0, r.doc_tokens) for r in got if r.start == 0)
    assert starts == sorted((i or 0, len(e)) for i, e in want)
    long = {r.start: bytes(r.ids) for r in got if r.doc_id == 5}
    assert b"".join(long[k] for k in sorted(long)) == next(e.tobytes() for i, e in want if i == 5) and len(LONG) > 2048
    crc = packing.pack_documents(odd, path).select(F.crc32("ids").alias("c"), "ids").collect()
    assert all(r.c == zlib.crc32(bytes(r.ids)) for r in crc)
    assert packing.pack_documents(nothing, path).count() == 0
