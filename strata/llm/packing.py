"""Documents packed into sequences of a token budget, balanced by what attention over them costs.

The cost of a piece of n tokens is estimated as ``linear * n + quadratic * n^2``. Documents are dealt into cells by a
hash; within a cell whole sequences are cut off the documents first, and the rests, by descending cost, go each to the
sequence of the lowest cost that has room for it. What then finds no room in one piece is cut and fills the sequences
up, again from the lowest cost. The room of a cell is exactly the number of its tokens: full sequences, and sequences
of powers of two for what is left over, so that nothing is padded.

Rows: null text counts as empty; the end id makes every document one token long at least. Rows with equal ids are
packed each. An empty table gives no pieces. A null doc_id is kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship, tidied
from strata.llm.tokens import encoder

CELL_ROWS = 1024
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def rooms(tokens: int, budget: int) -> np.ndarray:
    """Sequence lengths that add up to ``tokens``: full ones, then powers of two."""
    left = tokens % budget
    return np.array([budget] * (tokens // budget) + [1 << k for k in range(left.bit_length() - 1, -1, -1) if left >> k & 1], np.int64)


def pack(lengths: np.ndarray, budget: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces (row, start, length, sequence, offset) of documents with these token counts; lengths are positive."""
    out, done = [], 0
    for row, n in enumerate(lengths):
        for k in range(n // budget):
            out.append((row, k * budget, budget, done, 0))
            done += 1
    rest = lengths % budget
    size = rooms(int(rest.sum()), budget)
    room, cost = size.copy(), np.zeros(len(size))

    def put(row: int, n: int, s: int) -> None:
        out.append((row, int(lengths[row] - rest[row]), n, done + s, int(size[s] - room[s])))
        rest[row] -= n
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    order = np.argsort(-rest, kind="stable")
    late = []
    for row in order[: np.count_nonzero(rest)]:
        n = int(rest[row])
        fit = np.where(room >= n, cost, np.inf)
        s = int(fit.argmin())
        if fit[s] < np.inf:
            put(row, n, s)
        else:
            late.append(row)
    for row in late:
        while rest[row]:
            s = int(np.where(room > 0, cost, np.inf).argmin())
            put(row, int(min(rest[row], room[s])), s)
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    budget: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Every piece of every document with its ids (unsigned 32-bit little-endian, binary), sequence and place there."""
    ship(docs.sparkSession)
    cells = max(-(-docs.count() // cell_rows), 1)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        kind = coder.pool.dtype.newbyteorder("<")
        for batch in batches:
            ids, bounds = coder.encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], end_id).astype(kind)
            cuts = (bounds + np.arange(len(bounds))) * kind.itemsize
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(ids)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("doc_id"), packed], ["cell", "doc_id", "ids"])

    def place(table: pa.Table) -> pa.Table:
        kind = encoder(tokenizer).pool.dtype.newbyteorder("<")
        rows = sorted(
            zip(table["doc_id"].to_pylist(), table["ids"].to_pylist(), strict=True),
            key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
        )
        ids = [np.frombuffer(b, kind).astype("<u4") for _, b in rows]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        pieces = pack(lengths, budget, linear, quadratic)
        row, start, length, sequence, offset = (np.array(v, np.int64) for v in zip(*pieces, strict=True))
        base = table["cell"][0].as_py() << 32
        return pa.table(
            {
                "doc_id": pa.array([rows[r][0] for r in row], pa.int64()),
                "start": start,
                "length": length,
                "doc_tokens": lengths[row],
                "sequence_id": base + sequence,
                "offset": offset,
                "ids": pa.array([ids[r][a : a + n].tobytes() for r, a, n in zip(row, start, length)], pa.binary()),
            }
        )

    cell = F.pmod(F.xxhash64("doc_id", "text"), F.lit(cells)).alias("cell")
    coded = docs.select(cell, F.col("doc_id").cast("long"), "text").mapInArrow(
        tidied(encode), "cell long, doc_id long, ids binary"
    )
    return coded.groupBy("cell").applyInArrow(place, PIECES)
