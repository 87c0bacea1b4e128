"""Token ids of documents as flat binary files that can be memory-mapped.

A data set is a folder of shards. Shard ``k`` has ``k.ids`` (unsigned little-endian integers: 16 bits where the
vocabulary fits, else 32), ``k.offsets`` (64-bit: where each document begins in the shard, and its end) and
``k.docs`` (64-bit document ids). The manifest, a Parquet table, has one row per shard: its files, counts, and its base,
the number of ids in all shards before it, a prefix sum over the shards' counts. Documents lie in ascending doc_id.

Rows: null text counts as empty (only the end id is written). Null doc_ids come first and are written as the smallest
64-bit integer. Equal doc_ids are ordered by a hash of the text, then by the text; repeated rows are written each. An
empty table gives no shards. Other columns are not read.

The folder must be one that driver and executors share: any address that pyarrow's file systems know. A task writes
files named after its attempt, and only those of attempts that ended well get into the manifest, so a lost executor or
a second attempt leaves files that nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from strata.llm.ship import ship, tidied
from strata.llm.tokens import encoder

NO_ID = -(1 << 63)
READ_IDS = 1 << 20
SHARD = "shard int, name string, kind string, documents long, tokens long"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into ``folder`` and return the manifest."""
    spark = docs.sparkSession
    ship(spark)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name, out, total, count = f"{part:08d}-{uuid.uuid4().hex}", None, 0, 0
        coder = encoder(tokenizer)
        kind = coder.pool.dtype.newbyteorder("<")
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                files, path = _open(folder)
                files.create_dir(path, recursive=True)
                out = {k: files.open_output_stream(f"{path}/{name}.{k}") for k in ("ids", "offsets", "docs")}
                out["offsets"].write(np.zeros(1, "<i8").tobytes())
            ids, bounds = coder.encode(batch.column("text"))
            out["ids"].write(np.insert(ids, bounds[1:], end_id).astype(kind).tobytes())
            ends = total + bounds[1:] + np.arange(1, batch.num_rows + 1)
            out["offsets"].write(ends.astype("<i8").tobytes())
            out["docs"].write(batch.column("doc_id").fill_null(NO_ID).to_numpy().astype("<i8").tobytes())
            total, count = int(ends[-1]), count + batch.num_rows
        if out is not None:
            for stream in out.values():
                stream.close()
            row = [[part], [name], [kind.str], [count], [total]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                ["shard", "name", "kind", "documents", "tokens"],
            )

    order = ["doc_id", "__tie", "text"]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.xxhash64("text").alias("__tie"))
    shards = (
        rows.repartitionByRange("doc_id", "__tie")
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(tidied(shard), SHARD)
    )
    shards.write.parquet(f"{folder}/shards")
    before = W.Window.orderBy("shard").rowsBetween(W.Window.unboundedPreceding, -1)  # one row for each shard
    based = spark.read.schema(SHARD).parquet(f"{folder}/shards").withColumn(
        "base", F.coalesce(F.sum("tokens").over(before), F.lit(0))
    )
    based.coalesce(1).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{SHARD}, base long").parquet(f"{folder}/manifest")


def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is mounted, else read."""
    files, path = _open(folder)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", kind, "r") if files.get_file_info(f"{path}/{name}").size else np.zeros(0, kind)
    with files.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), kind)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the manifest: doc_id, start (ids of all documents before it), ids (unsigned 32-bit, binary)."""
    ship(spark)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _mapped(folder, f"{row['name']}.ids", row["kind"])
                ends = _mapped(folder, f"{row['name']}.offsets", "<i8")
                names = _mapped(folder, f"{row['name']}.docs", "<i8")
                first = 0
                while first < len(names):
                    last = int(np.searchsorted(ends, ends[first] + READ_IDS, "right")) - 1
                    last = min(max(last, first + 1), len(names))
                    some = ids[ends[first] : ends[last]].astype("<u4")
                    cuts = (ends[first : last + 1] - ends[first]) * 4
                    texts = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), last - first, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(some)]
                    ).cast(pa.binary())
                    own = np.asarray(names[first:last])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, mask=own == NO_ID), pa.array(row["base"] + ends[first:last]), texts],
                        ["doc_id", "start", "ids"],
                    )
                    first = last

    shards = read_manifest(spark, folder)
    spread = shards.repartition(max(shards.count(), 1), "shard")
    return spread.mapInArrow(documents, "doc_id long, start long, ids binary")
