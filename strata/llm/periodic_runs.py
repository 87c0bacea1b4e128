"""Periodic runs of words, found by uniting suffix classes in descending order of their common prefixes.

Only rows in which some short run of words occurs twice can hold a run; these are ordered by suffix (prefix doubling over
whole Arrow slices, in which only classes with several members are sorted again), and the common prefix of neighbours in that
order is read from the ranks of the doubling. Neighbours are then united from the longest common prefix down (Kruskal).
Every class keeps its positions in order. Two positions i < j that become neighbours when classes merge at length l have
exactly l words in common; with d = j - i and (exponent - 1) * d <= l, words i .. j + l - 1 have period d. Nothing of
the class lies between them, so d is their smallest period: a smaller one would have brought a nearer position into the class
at a greater length. The pair whose words before differ is the run's beginning, and each run has one.

The smaller class is merged into the larger one, so a row of m such suffixes takes O(m log m) steps. Memory is bounded by
about 8 bytes a level (log2 of the longest repeat) for each word of the slice, a slice being 1 MB of text or one longer row.

Rows: null text counts as empty, without runs; null ids are kept; repeated rows give repeated results; an empty table gives
none. Other columns are not read. Words are compared by 64-bit hashes, case kept.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship, tidied
from strata.llm.text import range_word_hashes, shingle_hashes, slices, word_bounds

LEAST_WORDS = 6
EXPONENT = 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_pairs(codes: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours (a, b) in the suffix order of each row, and how many words they share, where that is ``least`` or more.

    ``first``: where each row begins in ``codes``, and one past the last.
    """
    n = len(codes)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][row]
    _, key = np.unique(codes, return_inverse=True)
    key = row * (int(key.max()) + 1) + key
    active = np.argsort(key, kind="stable")
    key = key[active]
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1
    base = np.zeros(n, np.int64)  # the rank before, of the active ones
    start = np.zeros(n, np.int64)  # where that class begins among the active ones
    levels, width = [], 1
    while True:
        new = np.ones(len(active), bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))
        rank[active] = base + begin - start
        levels.append(rank.astype(np.int32 if n < 1 << 31 else np.int64))
        several = ~new
        several[:-1] |= ~new[1:]
        active = active[several]
        if not len(active):
            break
        base = rank[active]
        further = active + width
        second = np.where(further < end[active], rank[np.minimum(further, n)] + 1, 0)
        order = np.lexsort((second, base))
        active, base, second = active[order], base[order], second[order]
        fresh = np.ones(len(active), bool)
        fresh[1:] = base[1:] != base[:-1]
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))
        key = base * (n + 1) + second
        width *= 2
    order = np.empty(n, np.int64)
    order[rank[:n]] = np.arange(n)
    a, b = order[:-1], order[1:]
    floor = levels[min(least.bit_length() - 1, len(levels) - 1)]  # classes of words that are shared anyway
    near = floor[a] == floor[b]
    a, b = a[near], b[near]
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a + shared] == levels[k][b + shared]
        shared[same] += 1 << k
    keep = shared >= least
    return a[keep], b[keep], shared[keep]


def united_runs(pairs: Iterator[tuple[int, int, int]], codes: np.ndarray, begin: int, least_words: int, exponent: int) -> list:
    """Runs (start, length, period) of the row that begins at ``begin``, from its pairs by descending shared length."""
    runs: list[tuple[int, int, int]] = []
    classes: dict[int, list[int]] = {}

    def meet(i: int, j: int, shared: int) -> None:
        d = j - i
        if (exponent - 1) * d <= shared and d + shared >= least_words and (i == begin or codes[i - 1] != codes[j - 1]):
            runs.append((i - begin, d + shared, d))

    for a, b, shared in pairs:
        large, small = classes.get(a) or [a], classes.get(b) or [b]
        if len(large) < len(small):
            large, small = small, large
        for k, x in enumerate(small):
            at = bisect(large, x)
            if at and (k == 0 or small[k - 1] < large[at - 1]):
                meet(large[at - 1], x, shared)
            if at < len(large) and (k == len(small) - 1 or small[k + 1] > large[at]):
                meet(x, large[at], shared)
        if len(large) == 1:
            classes[large[0]] = large
        for x in small:
            insort(large, x)
            classes[x] = large
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _repeating(codes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Rows in which ``size`` words in a row occur twice."""
    grams, bounds = shingle_hashes(codes, first, size)
    row = np.repeat(np.arange(len(first) - 1), np.diff(bounds))
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    return np.unique(row[1:][(grams[1:] == grams[:-1]) & (row[1:] == row[:-1])])


def find_runs(codes: np.ndarray, first: np.ndarray, least_words: int = LEAST_WORDS, exponent: int = EXPONENT) -> dict[int, list]:
    """Runs of each row that has any."""
    least = min(max(least_words - q, (exponent - 1) * q) for q in range(1, least_words + 1))
    rows = _repeating(codes, first, min(least, 8))
    if not len(rows):
        return {}
    size = np.diff(first)[rows]
    inner = np.concatenate(([0], np.cumsum(size)))
    chosen = np.repeat(first[rows] - inner[:-1], size) + np.arange(inner[-1])
    codes = codes[chosen]
    a, b, shared = suffix_pairs(codes, inner, least)
    owner = np.searchsorted(inner, a, "right") - 1
    order = np.lexsort((-shared, owner))
    a, b, shared, owner = a[order], b[order], shared[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
    found = {}
    for k, row in enumerate(rows.tolist()):
        part = slice(bounds[k], bounds[k + 1])
        pairs = zip(a[part].tolist(), b[part].tolist(), shared[part].tolist(), strict=True)
        runs = united_runs(pairs, codes, int(inner[k]), least_words, exponent)
        if runs:
            found[row] = runs
    return found


def _collapsed(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    stay = np.cumsum(edge[:-1], dtype=np.int8) > 0
    total = np.concatenate(([0], np.cumsum(kept)))
    later = kept & (total[:-1] > np.repeat(total[first[:-1]], np.diff(first)))  # has a kept word before it in its row
    data = data.copy()
    data[starts[later] - 1] = 0x20
    stay[starts[later] - 1] = True
    bounds = np.concatenate(([0], np.cumsum(stay)))[offsets]
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[stay])
    ).cast(pa.string())


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, runs (start, length, period, by start and period) and text without the words after each run's first period.

    A run is a longest stretch of words with smallest period q of at least ``least_words`` and ``exponent`` * q words.
    """
    ship(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in slices(batch.column("text")):
                starts, ends, first = word_bounds(data, offsets)
                kept = np.ones(len(starts), bool)
                found = find_runs(range_word_hashes(data, starts, ends), first, least_words, exponent)
                for row, runs in found.items():
                    for start, length, period in runs:
                        kept[first[row] + start + period : first[row] + start + length] = False
                count = [len(found.get(k, ())) for k in range(end - begin)]
                flat = np.array([run for k in sorted(found) for run in found[k]], np.int64).reshape(-1, 3)
                runs = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN)),
                )
                text = _collapsed(data, offsets, starts, ends, first, kept)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, end - begin), runs, text], ["doc_id", "runs", "text"]
                )

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, text string"
    return rows.mapInArrow(tidied(search), schema)


def tail_repeated(doc_id: Column, text: Column) -> Column:
    """The text of every tenth document with its words from some place on replaced by repeats of the first of them.

    h = crc32 of the id as text, g = floor(h / 10). Where h % 10 = 0 and there are n > 0 words, word i >= a becomes
    word a + (i - a) % p with a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A null id counts as empty text.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    g, n = F.floor(h / 10), F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & text.isNotNull() & (n > 0), changed).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """Of every document the number of runs, its longest one, and hashes of all runs and of the text that is left."""
    best = F.expr(
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), "
        "(x, y) -> if(x is null or y.length > x.length, y, x))"  # runs come by start and period
    )
    lines = F.expr(r"array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "text").select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
