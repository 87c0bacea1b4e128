"""Makes the package importable on executors, and other small Spark helpers."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package through ``addPyFile``, once for each application, and bound Arrow batches."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "strata_package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def tidy() -> None:
    """Give unused memory of this process back."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidied(fn: Callable) -> Callable:
    """``fn`` over batches, after which its worker gives unused memory back: it may stay idle beside other work."""

    def run(batches: Iterator) -> Iterator:
        yield from fn(batches)
        tidy()

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: CRC-32 of its id as text, modulo ``folds``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")
