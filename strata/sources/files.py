"""The few file-system questions a plan cannot answer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the machine's own functions open it; none where only Hadoop reaches it."""
    fs, at = _folder(spark, path)
    full = fs.makeQualified(at).toUri()
    return full.getPath() if full.getScheme() == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _folder(spark, path)
    return fs.exists(at)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 where there is none."""
    fs, at = _folder(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def folder_files(spark: SparkSession, path: str) -> int:
    """Number of files below a folder, counted without a list of them."""
    fs, at = _folder(spark, path)
    return fs.getContentSummary(at).getFileCount()


def newest_partition(spark: SparkSession, path: str, col: str) -> str | None:
    """Largest value of a partition column by the folder names alone."""
    fs, at = _folder(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(at)]
    return max((n.split("=", 1)[1] for n in names if n.startswith(f"{col}=")), default=None)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none where there is no folder."""
    fs, at = _folder(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(at)) if fs.exists(at) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one step: it is there whole or not at all once its writer has closed it."""
    fs, at = _folder(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(at, False)
    if not fs.rename(beside, at):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _folder(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
