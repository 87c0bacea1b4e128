"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from strata.sources.files import delete_folder

# Size-checked broadcasts, run-time skew splitting and UTC are all ordinary Spark settings: no join in this
# package carries a broadcast hint, so a side is shipped whole only while Catalyst (or AQE, from real shuffle
# sizes) sees it under autoBroadcastJoinThreshold; beyond it the join becomes a sort-merge join and AQE splits
# the partitions of hot keys.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
# on a cluster shuffles start with many partitions, which AQE joins to the advisory size; 200 would be far too few
CLUSTER = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000"}
_made: list[str] = []  # scratch folders that are still there


def build_session(app: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **({} if master else CLUSTER), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch_root() -> str:
    return tempfile.mkdtemp(prefix="strata-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of the machine; on a cluster the executors would
    not see it, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_scratch_root()
    path = f"{root.rstrip('/')}/strata/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Folders of :func:`scratch_dir` and :func:`written` made within the block are deleted when it ends.

    What the block hands on must not read from them any more.
    """
    kept = len(_made)
    try:
        yield
    finally:
        for path in _made[kept:]:
            delete_folder(spark, path)
        del _made[kept:]


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of one block; what is to follow it must run within the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe against lost executors.

    The table stays until the :func:`scratch_scope` around it ends, or the folder is emptied.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Like :func:`written`, for what ``make`` returns; the helper tables it makes on the way go once that is written."""
    path = scratch_dir(spark, label)
    with scratch_scope(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


@contextlib.contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like :func:`written`, for the time of one block; the files go when the block ends."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)
