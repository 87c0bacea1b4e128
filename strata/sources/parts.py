"""Text parts on a mounted file system, as a Spark data source.

Spark's own text writer goes through Hadoop's local file system, which starts a ``chmod`` process for every file and for
its checksum: some 10 ms a file, however small it is. Parts of a few lines cost little else, so they are written by
Python's ``open`` here. Tasks, retries and the commit stay Spark's: a task writes below a hidden folder of its own, and
only what the tasks that succeeded report moves into place.
"""

from __future__ import annotations

import os
import shutil
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# executors get these classes along with the job, not by import
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COLUMNS = ("ingestion_date", "repo_slug")
# what Spark escapes in the names of partition folders
ESCAPED = {c: f"%{c:02X}" for c in (*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^"))}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_of(values: tuple[str | None, ...]) -> str:
    """Partition folders as Spark names them; null and empty text share one."""
    return "/".join(f"{c}={v.translate(ESCAPED) if v else NO_VALUE}" for c, v in zip(COLUMNS, values))


@dataclass
class Written(WriterCommitMessage):
    """A task's own folder and the partition folders in it."""

    own: str
    folders: list[str]


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, root: str, max_records: int):
        self.root, self.max_records = root, max_records
        self.staging = f"{root}/.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        attempt, task = uuid.uuid4().hex, TaskContext.get().partitionId()
        own, folders = f"{self.staging}/{attempt}", {}
        out, current, held, part = None, None, 0, 0
        try:
            for batch in iterator:
                lines, *places = (batch.column(c).to_pylist() for c in ("value", *COLUMNS))
                for line, place in zip(lines, zip(*places)):
                    if place != current or held == self.max_records:
                        if out is not None:
                            out.close()
                        if place not in folders:
                            folders[place] = folder_of(place)
                            os.makedirs(f"{own}/{folders[place]}", exist_ok=True)
                        out = open(f"{own}/{folders[place]}/part-{task:05d}-{attempt}.c{part:03d}.txt", "xb")  # noqa: SIM115
                        current, held, part = place, 0, part + 1
                    out.write(line or b"")
                    out.write(b"\n")
                    held += 1
        finally:
            if out is not None:
                out.close()
        return Written(own, list(dict.fromkeys(folders.values())))

    def commit(self, messages: list[Written | None]) -> None:
        os.makedirs(self.root, exist_ok=True)
        replaced = set()
        for own, folder in ((m.own, f) for m in messages if m for f in m.folders):
            final = f"{self.root}/{folder}"
            if folder not in replaced:
                replaced.add(folder)
                if os.path.exists(final):
                    shutil.rmtree(final)
                os.makedirs(os.path.dirname(final), exist_ok=True)
                os.rename(f"{own}/{folder}", final)
            else:  # a folder that was split over several tasks
                for name in os.listdir(f"{own}/{folder}"):
                    os.rename(f"{own}/{folder}/{name}", f"{final}/{name}")
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class TextParts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "strata_text_parts"

    def schema(self) -> str:
        return "value binary, ingestion_date string, repo_slug string"

    def writer(self, schema, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options["path"].rstrip("/"), int(self.options["maxRecordsPerFile"]))


def write_parts(df: DataFrame, path: str, max_records: int) -> None:
    """Lines under ``ingestion_date=D/repo_slug=R`` below the mounted ``path``; the folders they fill are replaced.

    Lines of a folder should follow each other within their task, else it gets more parts than it needs.
    """
    df.sparkSession.dataSource.register(TextParts)
    rows = df.select(F.col("value").cast("binary").alias("value"), *[F.col(c).cast("string").alias(c) for c in COLUMNS])
    rows.write.format(TextParts.name()).mode("append").option("maxRecordsPerFile", max_records).save(path)
