"""Document fingerprints: threshold-scaled sketches of shingle sets.

A shingle is a run of ``WIDTH`` bytes of the text (the whole text where it is shorter). Of the 64-bit shingle hashes a
sketch retains all below a fixed fraction of their range, ``1/SCALE``; a set of at most ``SMALL`` shingles is retained
whole (fraction 1), so that short texts have a sketch too. A sketch keeps its scale: two sketches are compared at the
smaller fraction of the two, by dropping what lies above, so that estimates of containment and Jaccard similarity hold
between documents of very unequal sizes, and sketches of parts merge by union at that fraction.

As text: the scale, a colon, and the retained hashes cut to 48 bits, sorted, in hexadecimal, twelve digits each.

Rows: null text counts as empty; an empty text has no shingles, and its likeness is 1 to an empty text and 0 to any
other. Any column but text is left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship
from strata.llm.text import SLICE_BYTES, SLICE_ROWS, BYTE, distinct, mix
from strata.llm.text import _power as powers

WIDTH = 9
SCALE = 16
SMALL = 256
DIGITS_BITS = 48


def sketches(texts: list[bytes]) -> list[tuple[int, np.ndarray]]:
    """(scale, sorted retained hashes of 48 bits) of each text."""
    out: list[tuple[int, np.ndarray]] = []
    row = 0
    while row < len(texts):
        end, size = row, 0
        while end < len(texts) and end - row < SLICE_ROWS and (end == row or size + len(texts[end]) <= SLICE_BYTES):
            size += len(texts[end])
            end += 1
        out += _some(texts[row:end])
        row = end
    return out


def _some(texts: list[bytes]) -> list[tuple[int, np.ndarray]]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * up[:-1], out=total[1:])
    runs = max(len(data) - WIDTH + 1, 0)
    hashes = mix((total[WIDTH:] - total[:runs]) * down[:runs] + np.uint64(WIDTH))
    below = hashes < np.uint64((1 << 64) // SCALE)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a < WIDTH:
            own = mix((total[b : b + 1] - total[a : a + 1]) * down[a : a + 1] + np.uint64(b - a)) if b > a else hashes[:0]
            out.append((1, own >> np.uint64(64 - DIGITS_BITS)))
            continue
        own = hashes[a : b - WIDTH + 1]
        scale = 1 if len(own) <= SMALL or len(distinct(own)) <= SMALL else SCALE
        kept = own if scale == 1 else own[below[a : b - WIDTH + 1]]
        out.append((scale, distinct(kept >> np.uint64(64 - DIGITS_BITS))))
    return out


def as_text(sketch: tuple[int, np.ndarray]) -> str:
    scale, kept = sketch
    raw = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return f"{scale}:{raw.hex()}"


def from_text(text: str) -> tuple[int, np.ndarray]:
    scale, _, digits = text.partition(":")
    raw = np.frombuffer(bytes.fromhex(digits), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return int(scale), wide.view(">u8").ravel().astype(np.uint64)


def _at_one_scale(x: tuple[int, np.ndarray], y: tuple[int, np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    scale = max(x[0], y[0])
    top = np.uint64((1 << DIGITS_BITS) // scale)
    return scale, *(kept if own == scale else kept[kept < top] for own, kept in (x, y))


def likeness(x: tuple[int, np.ndarray], y: tuple[int, np.ndarray]) -> float:
    """Estimated Jaccard similarity, from 0 to 1."""
    _, a, b = _at_one_scale(x, y)
    if not len(a) and not len(b):
        same = x[0] == y[0] and np.array_equal(x[1], y[1])
        return float(same)
    both = np.sort(np.concatenate((a, b)))
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def containment(x: tuple[int, np.ndarray], y: tuple[int, np.ndarray]) -> float:
    """Estimated share of the shingles of ``x`` that ``y`` has; 1 for an empty ``x``."""
    _, a, b = _at_one_scale(x, y)
    return float(np.isin(a, b).mean()) if len(a) else float(not len(x[1]))


def merge(x: tuple[int, np.ndarray], y: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
    """The sketch of two sets together."""
    scale, a, b = _at_one_scale(x, y)
    return scale, distinct(np.concatenate((a, b)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with a column fingerprint."""
    ship(docs.sparkSession)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([as_text(s) for s in sketches([(t or "").encode() for t in texts])], dtype=object)

    return docs.withColumn("fingerprint", F.pandas_udf(run, "string")(F.coalesce("text", F.lit(""))))


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_likeness(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Every document beside an edited text whose last quarter is the start of the next document, and beside that.

    Documents are dealt by ranges of the doc_id, cut at approximate quantiles, and the first document of the following
    bucket is sent along with each bucket (of the first bucket for the last one), so that texts are moved once and no
    task sees more than its range. Rows with the same doc_id are ordered by a hash of the text, then by the text; a null
    doc_id counts as before all others. A single row is its own next document.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keys = rows.select("doc_id")
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = keys.agg(
        F.percentile_approx("doc_id", [k / count for k in range(1, count)], 100 * count) if count > 1 else F.lit(None)
    ).first()[0]
    edges = np.unique(np.array(cuts or [], np.int64))

    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(edges, ids.fillna(0).astype("int64"), "right")))

    dealt = rows.withColumn("bucket", F.pandas_udf(bucket, "long")("doc_id"))
    order = F.struct(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("tie"), F.col("doc_id")
    )
    firsts = sorted(
        (r["bucket"], r["first"])
        for r in dealt.groupBy("bucket").agg(F.min(order).alias("first")).collect()  # one row for each bucket
    )
    if not firsts:
        return spark.createDataFrame([], EDITED)
    before = [(x["id"], x["tie"], firsts[k - 1][0], k == 0) for k, (_, x) in enumerate(firsts)]
    ahead = spark.createDataFrame(before, "id long, tie long, bucket long, wraps boolean")
    keyed = dealt.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("tie", F.xxhash64("text"))
    ghosts = keyed.drop("bucket").join(F.broadcast(ahead), ["id", "tie"]).select(
        "bucket", F.lit(1).alias("ghost"), "doc_id", "id", "tie", "text"
    )
    both = keyed.select("bucket", F.lit(0).alias("ghost"), "doc_id", "id", "tie", "text").union(ghosts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("bucket", "ghost", "doc_id", "text")), strict=True)
            if len(held) > 1:
                yield _edit(held)
                held = held[-1:]

    spread = both.repartitionById(len(edges) + 1, F.col("bucket").cast("int"))
    spread = spread.sortWithinPartitions("bucket", "ghost", "id", "tie", "text")
    return spread.select("bucket", "ghost", "doc_id", "text").mapInArrow(run, EDITED)


def _edit(rows: list[tuple]) -> pa.RecordBatch:
    """Each row but the last with its follower; a row that only follows is not returned."""
    edited = []
    for (_, _, _, text), (_, _, _, following) in zip(rows[:-1], rows[1:], strict=True):
        cut = len(text) // 4
        edited.append(text[: len(text) - cut] + following[:cut])
    own = [k for k in range(len(rows) - 1) if not rows[k][1]]
    plain = sketches([r[3].encode() for r in rows])
    coded = [edited[k].encode() for k in own]
    other = sketches(coded)
    columns = {
        "doc_id": pa.array([rows[k][2] for k in own], pa.int64()),
        "n_chars": pa.array([len(rows[k][3]) for k in own], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in coded], pa.string()),
        "fingerprint": pa.array([as_text(plain[k]) for k in own], pa.string()),
        "edited_fingerprint": pa.array([as_text(s) for s in other], pa.string()),
        "near_edited": pa.array([likeness(plain[k], s) for k, s in zip(own, other, strict=True)], pa.float64()),
        "near_next": pa.array([likeness(plain[k], plain[k + 1]) for k in own], pa.float64()),
    }
    return pa.RecordBatch.from_pydict(columns)
