"""Spelling variants: words one edit apart, found by tiles of padded code-point matrices.

Two words of lengths l and l or l + 1 are one edit apart if their common prefix and suffix together reach the longer length
minus one. The point where the suffix begins in the shorter word lies in one of three windows that share out 0 .. l; before
and behind that window both words agree. So every word goes to the blocks (l, window, what stands before, what stands
behind) of its own length and of the length below, and only words of one block are compared, window against window: pairs of
rows of two matrices, one aligned left and one right. A pair counts in the one block that holds its point, so that nothing is
counted twice and no pair leaves a task: of each word the number of near words and the most frequent one do.

Blocks of more than ``BLOCK`` words are split into three narrower windows, as often as needed. A window of one code point can't
be split; its words differ in no other place, and it holds at most as many words of the shorter length as there are code points.
Blocks are counted by a combined aggregation before any of them is gathered, so a frequent beginning or ending of words never
collects a large group in a task.

Rows: null text has no words; a null id counts as empty text; rows with one id each count. Extra columns are not read.
An empty table gives no rows. Ties among near words go to the one that is smallest in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship, tidied
from strata.session import written, written_alone

LETTERS = "a-zÀ-ÿ"  # after lower-casing A-Z
LEAST_CHARS = 7
LEAST_COUNT = 2
RATIO = 10
BLOCK = 1024
CELLS = 1 << 22
HELD_WORDS = 300_000  # of a task's counts before they are sent
HELD_ROWS = 50_000  # of blocks before they are compared
KEY = ["key", "base", "lo", "hi"]
SENT = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _sent(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=SENT)


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, slips: int = 0) -> DataFrame:
    """word, n: the runs of letters of at least ``least_chars`` code points that occur ``least_count`` times or more.

    With ``slips`` k, a run loses the code point h % length if k divides h, the crc32 of ``<doc_id>:<run>``.
    """
    ship(docs.sparkSession)
    runs = re.compile(f"[{LETTERS}]{{{least_chars},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                own = runs.findall(bytes(text.as_buffer()).lower().decode())  # of bytes, only A-Z are lowered
                if not slips:
                    counts.update(own)
                    continue
                seed = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(own).items():
                    h = zlib.crc32(run.encode(), seed)
                    if h % slips == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_chars:
                            continue
                    counts[run] += n
                if len(counts) > HELD_WORDS:
                    yield _sent(counts)
                    counts.clear()
        yield _sent(counts)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    found = rows.mapInArrow(tidied(count), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _blocks(words: DataFrame) -> DataFrame:
    """Each word in its blocks: of its own length, where it may be the shorter one, and of the length below."""
    base = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("base")
    third = F.explode(F.array(*map(F.lit, range(3)))).alias("third")
    windows = words.select("word", "n", base).select("*", third).select("word", "n", "base", *_third(F.lit(0), F.col("base")))
    return _keyed(windows)


def _third(lo, hi) -> list:
    part = lambda k: (lo + F.floor((hi - lo) * k / 3)).cast("int")
    return [part(F.col("third")).alias("lo"), part(F.col("third") + 1).alias("hi")]


def _keyed(windows: DataFrame) -> DataFrame:
    before, behind = F.left("word", F.col("lo")), F.right("word", F.col("base") - F.col("hi"))
    return windows.filter("hi > lo").select("word", "n", F.xxhash64("base", "lo", "hi", before, behind).alias("key"), "base", "lo", "hi")


def _split(rows: DataFrame, block: int) -> DataFrame:
    """Blocks of more than ``block`` words made narrower until there are none."""
    rows, done = written(rows, "blocks"), []
    while True:
        size = rows.filter("hi - lo > 1").groupBy(*KEY).count()
        large = written(size.filter(F.col("count") > block).select(*KEY), "large-blocks")
        if large.isEmpty():
            return _together([*done, rows])
        done.append(rows.join(large, KEY, "left_anti").select("word", "n", *KEY))
        third = F.explode(F.array(*map(F.lit, range(3)))).alias("third")
        inner = rows.join(large, KEY, "left_semi").select("word", "n", "base", "lo", "hi", third)
        rows = written(_keyed(inner.select("word", "n", "base", *_third(F.col("lo"), F.col("hi")))), "blocks")


def _together(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _matrices(parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of each part, padded, aligned left and (from the end) right, and their numbers."""
    flat = np.frombuffer("".join(parts.to_pylist()).encode("utf-32-le"), np.uint32)
    if len(flat) == 0 or flat.max() < 256:
        flat = flat.astype(np.uint8)
    size = pc.utf8_length(parts).to_numpy()
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(flat)) - begin[row]
    left = np.zeros((len(size), int(size.max(initial=0))), flat.dtype)
    right = left.copy()
    left[row, place] = flat
    right[row, size[row] - 1 - place] = flat
    return left, right, size


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many columns of each row agree before the first one that doesn't."""
    differ = np.ones((len(a), a.shape[1] + 1), bool)
    np.not_equal(a, b, out=differ[:, :-1])
    return differ.argmax(1)


def near_pairs(begin: np.ndarray, group: np.ndarray, width: np.ndarray, front: np.ndarray, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that are one edit apart and whose point lies in their block's window.

    Rows come by block, the shorter words first; ``group`` numbers the blocks and ``begin`` tells where they begin.
    ``width`` and ``front`` (whether it is the first) describe the window of each row, ``parts`` is the text inside.
    """
    left, right, size = _matrices(parts)
    last = np.append(begin[1:], len(group))[group]
    partners = np.where(size == width, last - np.arange(len(group)) - 1, 0)  # later rows of the block
    total = np.concatenate(([0], np.cumsum(partners)))
    tile = max(1, CELLS // max(left.shape[1], 1))
    found = []
    for low in range(0, int(total[-1]), tile):
        pair = np.arange(low, min(low + tile, int(total[-1])))
        i = np.searchsorted(total, pair, "right") - 1
        j = i + 1 + pair - total[i]
        w = width[i]
        prefix = np.minimum(_agreeing(left[i], left[j]), w)
        suffix = np.minimum(_agreeing(right[i], right[j]), w)
        near = (prefix + suffix >= size[j] - 1) & ((suffix < w) | front[i])
        found.append((i[near], j[near]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _compare(rows: pa.Table) -> pa.RecordBatch | None:
    """Whole blocks: of each word that has near words, their number and the first of them by count and code points."""
    keys = [rows.column(c).to_numpy() for c in KEY]
    new = np.ones(rows.num_rows, bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    begin, group = np.flatnonzero(new), np.cumsum(new) - 1
    lone = np.append(begin[1:], rows.num_rows) - begin == 1
    if lone.all():
        return None
    pick = np.flatnonzero(~lone[group])
    rows = rows.take(pa.array(pick))
    new = new[pick]
    begin, group = np.flatnonzero(new), np.cumsum(new) - 1
    lo, hi = rows.column("lo").to_numpy(), rows.column("hi").to_numpy()
    i, j = near_pairs(begin, group, hi - lo, lo == 0, rows.column("part").combine_chunks())
    if not len(i):
        return None
    n = rows.column("n").to_numpy()
    own, other = np.concatenate((i, j)), np.concatenate((j, i))
    rank = np.empty(rows.num_rows, np.int64)
    words = pa.table({"n": rows.column("n"), "word": rows.column("word")})
    rank[pc.sort_indices(words, [("n", "descending"), ("word", "ascending")]).to_numpy()] = np.arange(rows.num_rows)
    order = np.lexsort((rank[other], own))
    own, other = own[order], other[order]
    heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    count = np.diff(np.append(heads, len(own)))
    word = rows.column("word").combine_chunks()
    best = pa.array(other[heads])
    return pa.RecordBatch.from_arrays(
        [word.take(pa.array(own[heads])), pa.array(count), pa.array(n[other[heads]]), word.take(best)],
        ["word", "n_near", "near_n", "near_word"],
    )


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def compared(last: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        same = np.ones(rows.num_rows, bool)
        for c in KEY:
            column = rows.column(c).to_numpy()
            same &= column == column[-1]
        if not last and same.all():  # the one block may go on
            return
        cut = rows.num_rows if last else int(np.flatnonzero(~same)[-1]) + 1
        out = _compare(rows.slice(0, cut))
        held[:] = rows.slice(cut).to_batches()
        if out is not None:
            yield out

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= HELD_ROWS:
            yield from compared(False)
    if held:
        yield from compared(True)


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, near_n, near_word: how many words are one edit away, and the most frequent of them."""
    ship(words.sparkSession)
    rows = _split(_blocks(words), block)
    part = F.substring("word", F.col("lo") + 1, F.length("word") - F.col("base") + F.col("hi") - F.col("lo"))
    dealt = rows.withColumn("part", part).repartition(*KEY).sortWithinPartitions(*KEY, F.length("part"))
    kinds = "word string, n_near long, near_n long, near_word string"
    found = dealt.select("word", "n", *KEY, "part").mapInArrow(tidied(_tiles), kinds)
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("word"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(best).alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.word").alias("near_word"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """word, root from rows (word, form): the last form on the way, by doubling the way until nothing changes.

    Counts grow tenfold at every step, so there are few rounds, and no way leads back.
    """
    rows = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = rows.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if rows.join(further, "root", "left_semi").isEmpty():
            return rows
        rows = written(rows.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms")


def variant_forms(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Words (word, n; each once) with form, root, n, n_near and form_n.

    A word's form is its most frequent near word if that occurs at least ``ratio`` times as often; its root is the last
    word reached from form to form, or the word itself.
    """
    spark = words.sparkSession
    words = written(words.select("word", F.col("n").cast("long")), "words")
    common = F.col("near_n") >= F.col("n") * ratio

    def judge() -> DataFrame:
        return words.join(near_words(words, block), "word", "left").select(
            "word",
            F.when(common, F.col("near_word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(common, F.col("near_n")).alias("form_n"),
        )

    judged = written_alone(spark, judge, "judged")
    roots = written_alone(spark, lambda: _roots(judged.filter("form is not null")), "roots")
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
