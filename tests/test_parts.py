"""Small landed parts: written without Hadoop's cost per file, read whole."""

import pytest
from pyspark.sql import functions as F

from strata.session import setting
from strata.sources import files, raw

LINE = "value string, ingestion_date string, repo_slug string"


def lines_of(spark, path):
    read = spark.read.schema(LINE).text(path)
    return sorted(map(tuple, read.collect()), key=repr)


def test_small_parts_start_no_process_a_file(spark, tmp_path):
    """Hadoop's local file system runs chmod for each file and its checksum, and leaves the checksum beside it."""
    df = spark.range(200).select(F.concat("id", F.lit(" é")).alias("value"), F.lit("2024-03-01").alias("ingestion_date"),
                                 (F.col("id") % 2).cast("string").alias("repo_slug"))
    raw.write_raw(df, str(tmp_path / "raw"), max_records=20)
    parts = [p for p in (tmp_path / "raw").rglob("*") if p.is_file()]
    assert len(parts) == 10 and all(p.suffix == ".txt" and p.read_bytes().count(b"\n") == 20 for p in parts)
    assert [r.n for r in raw.part_lines(spark, str(tmp_path / "raw")).collect()] == [20] * 10


def test_small_parts_are_what_spark_writes(spark, tmp_path):
    """Folder names and lines agree with Spark's own writer for odd, empty and null values."""
    odd = ["a b", "x=1/y", "50%", "{[^'\"#*:?\\]}", "éü", "\x01\x7f\t", "", None, "plain"]
    rows = [(f"line {i} é" if i % 4 else None, d, r) for i, (d, r) in enumerate((d, r) for d in ("2024-03-01", None, "") for r in odd)]
    df = spark.createDataFrame(rows * 3, LINE)
    raw.write_raw(df, str(tmp_path / "small"), max_records=2)
    raw.write_raw(df, str(tmp_path / "large"))  # Spark's writer
    named = [sorted(str(p.parent.relative_to(tmp_path / n)) for p in (tmp_path / n).rglob("*.txt")) for n in ("small", "large")]
    assert sorted(set(named[0])) == sorted(set(named[1])) and len(set(named[0])) == 16
    one, two = (lines_of(spark, str(tmp_path / n)) for n in ("small", "large"))
    assert one == two and len(one) == 81
    assert raw.part_lines(spark, str(tmp_path / "small")).agg(F.sum("n"), F.max("n")).first()[:] == (81, 2)


def test_a_folder_of_several_tasks_is_whole_and_a_rerun_replaces_it(spark, tmp_path):
    path = str(tmp_path / "raw")

    def land(first, last, tasks):
        df = spark.range(first, last, 1, tasks).select(F.col("id").cast("string").alias("value"),
            F.lit("2024-03-01").alias("ingestion_date"), F.when(F.col("id") < 900, "hot").otherwise("cold").alias("repo_slug"))
        raw.write_raw(df, path, max_records=20, gathered=True)

    land(0, 1000, 5)
    assert sorted(int(r[0]) for r in lines_of(spark, path)) == list(range(1000))
    land(100, 800, 3)
    assert sorted(int(r[0]) for r in lines_of(spark, path)) == [*range(100, 800), *range(900, 1000)]
    assert raw.part_lines(spark, path).agg(F.max("n")).first()[0] == 20
    assert [p.name for p in (tmp_path / "raw").iterdir()] == ["ingestion_date=2024-03-01"]  # no staging is left
    land(0, 0, 1)
    assert len(lines_of(spark, path)) == 800


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    good = spark.createDataFrame([("a", "2024-03-01", "o")], LINE)
    raw.write_raw(good, path, max_records=20)
    bad = spark.range(0, 50, 1, 1).select(F.when(F.col("id") == 49, F.raise_error(F.lit("stop"))).otherwise("b").alias("value"),
        F.lit("2024-03-01").alias("ingestion_date"), F.lit("o").alias("repo_slug"))
    with pytest.raises(Exception, match="stop"):
        raw.write_raw(bad, path, max_records=20, gathered=True)
    assert lines_of(spark, path) == [("a", "2024-03-01", "o")]
    assert [p.name for p in (tmp_path / "raw").iterdir()] == ["ingestion_date=2024-03-01"]


def test_lines_of_a_part_are_the_text_readers(spark, tmp_path):
    for i, text in enumerate((b"", b"\n", b"a", b"a\nb", b"a\n\nb\n", "é\nü".encode())):
        folder = tmp_path / "ingestion_date=2024-03-01" / f"repo_slug=r{i}"
        folder.mkdir(parents=True)
        (folder / "p.txt").write_bytes(text)
    got = {r.repo_slug: r.n for r in raw.part_lines(spark, str(tmp_path)).collect()}
    want = {r.repo_slug: r["count"] for r in spark.read.text(str(tmp_path)).groupBy("repo_slug").count().collect()}
    assert got == want and set(want.values()) == {1, 2, 3}  # an empty part has no row


def test_only_mounted_paths_are_opened_directly(spark, tmp_path):
    assert files.mounted_path(spark, f"file://{tmp_path}/a b") == f"{tmp_path}/a b"
    assert files.mounted_path(spark, str(tmp_path)) == str(tmp_path)
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.parts.link./in", f"file://{tmp_path}")
    assert files.mounted_path(spark, "viewfs://parts/in/x") is None
    df = spark.createDataFrame([(str(i), "2024-03-01", "o") for i in range(30)], LINE)
    raw.write_raw(df, "viewfs://parts/in/x", max_records=20)  # through Spark's writer
    assert sorted(r.n for r in raw.part_lines(spark, "viewfs://parts/in/x").collect()) == [10, 20]


def test_a_task_reads_many_parts_and_the_setting_is_given_back(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").cast("string").alias("value"), F.lit("2024-03-01").alias("ingestion_date"), F.lit("o").alias("repo_slug"))
    raw.write_raw(df, str(tmp_path / "raw"), max_records=2)
    key, before = "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.openCostInBytes")
    with setting(spark, "spark.sql.files.maxPartitionBytes", "16m"):
        got = raw.part_lines(spark, str(tmp_path / "raw"))
        assert len(got.inputFiles()) <= 16  # a task leaves one file; 1,000 parts at 4 MB each would be 250 tasks
    assert got.count() == 1000 and got.agg(F.sum("n")).first()[0] == 2000
    assert spark.conf.get(key) == before
    spark.conf.set(key, "1m")
    with setting(spark, key, "2m"):
        assert spark.conf.get(key) == "2m"
    assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)


def test_dates_are_read_a_few_at_a_time(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    day = F.concat(F.lit("2024-03-0"), (F.col("id") % 5 + 1).cast("string")).alias("ingestion_date")
    raw.write_raw(spark.range(100).select(F.col("id").cast("string").alias("value"), day, F.lit("o").alias("repo_slug")), path, max_records=4)
    whole = sorted(map(tuple, raw.part_lines(spark, path).collect()))
    dates = [f"{path}/{name}" for name in files.names(spark, path)]
    monkeypatch.setattr(raw, "LISTED", 12)
    assert [len(some) for some in raw._few_parts(spark, dates)] == [2, 2, 1]
    assert sorted(map(tuple, raw.part_lines(spark, path).collect())) == whole and len(whole) == 25
    monkeypatch.setattr(raw, "LISTED", 1)
    assert [len(some) for some in raw._few_parts(spark, dates)] == [1] * 5


def test_nothing_landed_gives_no_part(spark, tmp_path):
    raw.write_raw(spark.createDataFrame([], LINE), str(tmp_path / "raw"), max_records=4)
    assert raw.part_lines(spark, str(tmp_path / "raw")).collect() == []
