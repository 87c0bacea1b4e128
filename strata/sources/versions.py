"""Whole tables replaced at once: a new version is written beside the old one, then a small file says that it counts.

``<table>/_versions/<number>`` holds the rows and ``<table>/_versions/<number>.committed`` makes them the table. Readers take the
newest committed version, so a job that dies at any moment leaves the old table or the new one, never none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.files import delete_folder, names, write_text

VERSIONS = "_versions"
COMMITTED = ".committed"


def _committed(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(COMMITTED)) for n in names(spark, f"{path}/{VERSIONS}") if n.endswith(COMMITTED))


def _folder(path: str, number: int) -> str:
    return f"{path}/{VERSIONS}/{number:010d}"


def version_folder(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that counts; None where none was written this way."""
    found = _committed(spark, path)
    return _folder(path, found[-1]) if found else None


def write_version(df: DataFrame, path: str) -> str:
    """Rows of a new version, which do not count yet; returns their folder. ``df`` may derive from the version before."""
    spark = df.sparkSession
    numbers = [int(n.removesuffix(COMMITTED)) for n in names(spark, f"{path}/{VERSIONS}") if n[:10].isdigit()]
    folder = _folder(path, max(numbers, default=0) + 1)
    df.write.parquet(folder)
    return folder


def commit_version(spark: SparkSession, folder: str) -> None:
    write_text(spark, folder + COMMITTED, "")


def overwrite_table(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Replace the table at ``path`` by ``df``; the last ``keep`` versions stay, for readers that are still at work."""
    spark = df.sparkSession
    folder = write_version(df, path)
    commit_version(spark, folder)
    free_versions(spark, path, keep)
    return spark.read.schema(df.schema).parquet(folder)


def free_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions, and what stopped jobs have left; returns how many folders went."""
    done = _committed(spark, path)
    stay = set(done[-keep:])
    gone = [n for n in names(spark, f"{path}/{VERSIONS}") if n.isdigit() and int(n) not in stay]
    if done:
        gone = [n for n in gone if int(n) <= done[-1]]  # a later one is being written
    for n in gone:
        delete_folder(spark, _folder(path, int(n)) + COMMITTED)
        delete_folder(spark, _folder(path, int(n)))
    return len(gone)
