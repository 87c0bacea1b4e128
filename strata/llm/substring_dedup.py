"""Repeated passages: runs of consecutive pieces of sentences are hashed, and what repeats is removed but once.

A sentence ends with a word whose last byte is ``.``, ``!`` or ``?``, or before a line end. Sentences of more than ``LONG``
words are cut into pieces: of every ``WINDOW`` words of one, the word with the smallest hash (the last such) ends a piece, so
that cuts follow from the words around them and are never further apart than that. A span begins at any piece and takes
pieces until it has ``SPAN_WORDS`` words; one that begins at a sentence also takes ``RUN`` sentences in a row (all of a
shorter document), or more until it has ``LEAST_WORDS`` words. Spans are compared word by word after lower-casing A-Z.

Of a passage that stands in mid-sentence at most 2 * ``WINDOW`` - 1 words are lost before the first common cut, and 2 *
``WINDOW`` - 2 (or ``LONG``) after the last; a piece has ``LONG`` words at most. So a passage of 21 + ``SPAN_WORDS`` + ``LONG`` - 1
= 51 words always holds a common span, wherever it stands.

The first span of its kind, by (doc_id, position),
stays; pieces covered by any later one are removed, with the white space behind them.

A document sends each of its different spans once; repeats within a document are seen without a shuffle. Two shuffles on
the span's hash find what several documents share; counting is combined before the first, and the second is a join whose
hot keys Spark splits. A document gets back the hashes of its spans that occur in earlier ones.

Rows: null text stays null, with no sentences. Rows with the same doc_id count as one document: what they share with
each other stays. A null doc_id comes before all others. An empty table gives no rows. All columns are kept; the text is
replaced, and so is a column that has the name of a new one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship
from strata.llm.text import _power, mix, slices, word_bounds, word_hashes

RUN = 3
LEAST_WORDS = 12
LONG = 10
WINDOW = 6
SPAN_WORDS = 21
NO_ID = -(1 << 63)


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words, the number of the first word of each piece (and one past the last), for each row the number of
    its first piece, the numbers of pieces that begin a sentence, and where words begin in the bytes."""
    starts, ends, first = word_bounds(data, offsets)
    words, _ = word_hashes(data, offsets)
    if not len(words):
        return words, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), starts
    line_ends = np.concatenate(([0], np.cumsum(data == 0x0A)))
    last = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8))
    last[:-1] |= line_ends[starts[1:]] > line_ends[ends[:-1]]
    last[first[1:][np.diff(first) > 0] - 1] = True
    begin = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1))
    size = np.diff(np.append(begin, len(words)))
    left = np.repeat(begin + size, size) - np.arange(len(words))  # words of the sentence from this one on
    window = np.flatnonzero(np.repeat(size > LONG, size) & (left >= WINDOW))
    least, at = words[window], window.copy()
    for k in range(1, WINDOW):
        other = words[window + k]
        at = np.where(other <= least, window + k, at)
        least = np.minimum(other, least)
    last[at] = True
    cuts = np.concatenate(([0], np.flatnonzero(last) + 1))
    return words, cuts, np.searchsorted(cuts[:-1], first), np.searchsorted(cuts, begin), starts


def spans(
    words: np.ndarray, cuts: np.ndarray, rows: np.ndarray, heads: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every span: its row, the number of its first piece there, how many pieces it has, and its hash."""
    count = np.diff(rows)
    row = np.repeat(np.arange(len(count)), count)
    begin = np.arange(len(row))  # pieces of all rows, one after the other
    end = np.searchsorted(cuts, cuts[begin] + SPAN_WORDS)

    edges = np.append(heads, len(row))  # sentences of all rows
    of_row = np.searchsorted(heads, rows)
    whose, k = row[heads], np.arange(len(heads))
    run = np.maximum(
        k + np.minimum(RUN, np.diff(of_row)[whose]), np.searchsorted(cuts[edges], cuts[heads] + LEAST_WORDS)
    )
    keep = run <= of_row[whose + 1]
    start, stop = heads[keep], edges[run[keep]]
    shorter = np.full(len(row), len(row) + 1)
    shorter[start] = stop
    keep = (end <= rows[row + 1]) & (end < shorter)

    begin, end = np.concatenate((begin[keep], start)), np.concatenate((end[keep], stop))
    order = np.lexsort((end, begin))
    begin, end = begin[order], end[order]
    row = row[begin]
    place, size = begin - rows[row], end - begin
    a, b = cuts[begin], cuts[end]
    up, down = _power(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:-1], out=total[1:])
    return row, place, size, mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))


def _first_in_row(row: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which spans are the first of their kind in their row."""
    order = np.lexsort((np.arange(len(row)), codes, row))
    new = np.ones(len(row), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (codes[order][1:] != codes[order][:-1])
    out = np.zeros(len(row), bool)
    out[order] = new
    return out


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc").to_numpy()
        for begin, _, data, offsets in slices(batch.column("text")):
            words, cuts, rows, heads, _ = sentences(data, offsets)
            row, _, _, codes = spans(words, cuts, rows, heads)
            first = _first_in_row(row, codes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[first].view(np.int64)), pa.array(doc[begin + row[first]])], ["span", "doc"]
            )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages removed from the text, and two more columns: n_sentences and n_removed (pieces)."""
    ship(docs.sparkSession)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    found = docs.select(doc.alias("doc"), "text").mapInArrow(_emit, "span long, doc long")
    ends = found.groupBy("span").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    later = found.join(ends.select("span", "first"), "span").filter("doc > first")
    known = later.groupBy("doc").agg(F.collect_set("span").alias("__spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = batch.column("__spans")
            for begin, end, data, offsets in slices(batch.column("text")):
                words, cuts, rows, heads, starts = sentences(data, offsets)
                row, place, size, codes = spans(words, cuts, rows, heads)
                again = ~_first_in_row(row, codes)
                at = rows[row] + place
                bounds = np.searchsorted(row, np.arange(end - begin + 1))
                for k in range(end - begin):
                    if shared[begin + k].is_valid:
                        part = slice(bounds[k], bounds[k + 1])
                        again[part] |= np.isin(codes[part].view(np.int64), shared[begin + k].values.to_numpy())
                edge = np.zeros(len(cuts) + 1, np.int64)
                np.add.at(edge, at[again], 1)
                np.subtract.at(edge, at[again] + size[again], 1)
                gone = np.cumsum(edge)[: len(cuts)] > 0
                texts = []
                edges = np.append(starts, len(data))[cuts]  # where sentences begin in the bytes
                for k in range(end - begin):
                    a, b = rows[k], rows[k + 1]
                    if not gone[a:b].any():
                        texts.append(data[offsets[k] : offsets[k + 1]].tobytes())
                        continue
                    left = np.append(edges[a:b], offsets[k + 1])
                    parts = [data[offsets[k] : left[0]]] + [data[left[j] : left[j + 1]] for j in np.flatnonzero(~gone[a:b])]
                    texts.append(b"".join(p.tobytes() for p in parts))
                null = batch.column("text").slice(begin, end - begin).is_null().to_numpy(zero_copy_only=False)
                total = np.concatenate(([0], np.cumsum(gone[:-1])))
                columns = {c: batch.column(c).slice(begin, end - begin) for c in inner}
                columns["text"] = pa.array([None if n else t.decode() for t, n in zip(texts, null, strict=True)], pa.string())
                columns["n_sentences"] = pa.array(np.diff(rows))
                columns["n_removed"] = pa.array(total[rows[1:]] - total[rows[:-1]])
                yield pa.RecordBatch.from_pydict(columns)

    inner = [f"__col{k}" for k in range(len(docs.columns)) if docs.columns[k] != "text"]
    names = [c for c in docs.columns if c != "text"]
    kept = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(names, inner, strict=True)), "text", doc.alias("doc"))
    joined = kept.join(known, "doc", "left").select(*inner, "text", "__spans")
    kinds = ", ".join(f"{n} {kept.schema[n].dataType.simpleString()}" for n in inner)
    out = joined.mapInArrow(remove, f"{kinds}{', ' if kinds else ''}text string, n_sentences long, n_removed long")
    back = dict(zip(names, inner, strict=True))
    new = ("n_sentences", "n_removed")
    return out.select(*(F.col(back.get(c, "text")).alias(c) for c in docs.columns if c not in new), *new)
