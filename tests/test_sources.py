"""Sources, sinks and the stream front end."""

import landing
import pytest
from pyspark.sql import functions as F

from strata.plans import staging
from strata.session import scratch_dir, staged
from strata.sources import bronze, files, raw, tables, volumes
from strata.streaming.landing import follow_bronze, follow_raw


def at(day):
    return F.lit(f"{day} 02:00:00").cast("timestamp")


def test_bronze_reads_older_files_without_a_column(spark, tmp_path):
    path = str(tmp_path / "bronze")
    landing.land(str(tmp_path / "raw"), "2024-03-01", {"issues": landing.day_one()["issues"]})
    lines = bronze.parse_bronze(bronze.scan_raw(spark, str(tmp_path / "raw")), at("2024-03-01"), "2024-03-01")
    bronze.replace_partitions(lines.drop("_source_endpoint"), path, ["_ingestion_date"])
    again = lines.withColumn("_ingestion_date", F.lit("2024-03-02")).withColumn("extra", F.lit(1))
    bronze.replace_partitions(again, path, ["_ingestion_date"])
    df = bronze.read_bronze(spark, path)
    assert df.count() == 24 and df.filter("_source_endpoint is not null").count() == 10
    assert "extra" in bronze.read_bronze(spark, path, merge_schema=True).columns
    assert files.newest_partition(spark, path, "_ingestion_date") == "2024-03-02"
    plan = bronze.latest_partition(df, "_ingestion_date", "2024-03-02")
    assert plan.count() == 12
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_date" in text and "2024-03-02" in text


def test_registered_table_sees_new_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in ("2024-03-01", "2024-03-02"):
        bronze.replace_partitions(spark.range(3).withColumn("_ingestion_date", F.lit(day)), path, ["_ingestion_date"])
        bronze.register_external(spark, "seen_dates", path)
    assert spark.table("seen_dates").count() == 6
    spark.sql("drop table seen_dates")


def test_load_stops_at_the_first_failure(spark, tmp_path):
    root = str(tmp_path)
    landing.land(f"{root}/raw", "2024-03-01", {"issues": landing.day_one()["issues"]})
    (tmp_path / "bronze").mkdir()
    (tmp_path / "bronze" / "issues").write_text("not a folder")
    with pytest.raises(Exception):
        bronze.load_all(spark, f"{root}/raw", f"{root}/bronze", "2024-03-01", at("2024-03-01"))


def test_raw_parts_are_bounded_and_rerun_replaces(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.range(95).select("id", F.when(F.col("id") < 90, "o/hot").otherwise("o/cold").alias("repo"))

    def land(n):
        lines = raw.wrap_envelope(df.filter(F.col("id") < n), "run", "/e", "2024-03-01", F.col("repo"), "u", at("2024-03-01"))
        raw.write_raw(lines, path, max_records=20)

    land(95)
    land(80)  # the hot folder is replaced, the cold one is not touched
    parts = list((tmp_path / "raw").glob("*/repo_slug=o_hot/*.txt"))
    assert sum(len(p.read_text().splitlines()) for p in parts) == 80
    assert all(len(p.read_text().splitlines()) <= 20 for p in parts)
    assert spark.read.text(path).count() == 85


def test_pull_request_nodes(spark):
    df = spark.createDataFrame([('{"databaseId": 1, "number": 2, "commits": {"totalCount": 3}}',), ("null",), (None,)], "n string")
    got = raw.normalize_pr_details(df, "n").collect()
    assert [(r.id, r.number, r.commits, r.review_comments) for r in got] == [(1, 2, 3, None)]


def test_volumes(spark):
    loaded = spark.createDataFrame([("duckdb/duckdb", "issues")] * 11 + [("x/y", "issues")], "repo string, resource string")
    got = {(r.repo, r.resource): (r.loaded, r.loaded_share) for r in
           volumes.load_vs_estimate(loaded, volumes.expected_volumes(spark)).collect()}
    assert got["duckdb/duckdb", "issues"] == (11, 0.0005) and got["x/y", "issues"] == (1, None)
    assert got["apache/spark", "pull_requests"] == (0, 0.0) and len(got) == 17


def test_export_needs_a_path(spark):
    with pytest.raises(ValueError):
        tables.export_tables({}, "")


def test_scratch_lies_in_the_shared_folder_and_staged_files_go(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch_dir(spark, "x").startswith(root)
    with staged(spark.range(3), "x") as df:
        assert df.count() == 3
        folder = df.inputFiles()[0].rsplit("/", 1)[0]
        assert files.path_exists(spark, folder)
    assert not files.path_exists(spark, folder)


def test_stream_gives_the_batch_result(spark, tmp_path):
    root, keys, order = str(tmp_path), ["issue_id"], ["updated_at", "_bronze_ingest_ts"]
    for day, content in zip(landing.DAYS, (landing.day_one(), landing.day_two())):
        landing.land(f"{root}/raw", day, {"issues": content["issues"]})
        follow_raw(spark, f"{root}/raw/issues", f"{root}/bronze", f"{root}/cp1").awaitTermination()
        follow_bronze(
            spark, f"{root}/bronze", f"{root}/table", f"{root}/cp2", staging.type_issues, keys, order,
            tables.hash_bucket(keys, 2),
        ).awaitTermination()
    lines = bronze.scan_raw(spark, f"{root}/raw")
    batch = staging.stage_issues(bronze.parse_bronze(lines, at("2024-03-02"))).filter("issue_id is not null")
    cols = ["issue_id", "state", "updated_at", "comments_count"]
    got = tables.read_table(spark, f"{root}/table")
    assert sorted(got.select(*cols).collect()) == sorted(batch.select(*cols).collect())
    assert spark.read.parquet(f"{root}/bronze").count() == lines.count()


def test_closed_history_is_compacted_without_loss(spark, tmp_path):
    from strata.sources import tables

    path, bucket = str(tmp_path / "history"), tables.hash_bucket(["k"], 2)
    for day in range(1, 5):
        batch = spark.createDataFrame([(k, day) for k in range(5)], "k int, updated_at int")
        tables.snapshot_by_timestamp(spark, path, batch, ["k"], "updated_at", bucket, f"run-{day}")
    before = sorted(map(tuple, tables.read_table(spark, path).select("k", "valid_from", "valid_to").collect()), key=repr)
    assert tables.compact_history(spark, path, keep=["run-4"]) == 10
    after = sorted(map(tuple, tables.read_table(spark, path).select("k", "valid_from", "valid_to").collect()), key=repr)
    assert after == before and len(after) == 20
    states = {r[0] for r in spark.read.parquet(path).select(tables.STATE).distinct().collect()}
    assert states == {"open", "archive", "run-4"}
    assert tables.compact_history(spark, path, keep=["run-4"]) == 0


def test_scratch_scope_deletes_what_it_made(spark):
    import os

    from strata.session import scratch_scope, written

    with scratch_scope(spark):
        path = written(spark.range(3), "gone").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_records_are_gathered_before_they_become_lines(spark, tmp_path):
    df = spark.range(95).select("id", F.when(F.col("id") < 90, "o/hot").otherwise("o/cold").alias("repo"))
    given = df, "run", "/e", "2024-03-01", F.col("repo"), "u", at("2024-03-01")
    lines = raw.wrap_envelope(*given, gather=True)
    plan = lines._jdf.queryExecution().analyzed().toString()
    assert plan.index("to_json") < plan.index("RebalancePartitions")  # the shuffle lies below the lines
    raw.write_raw(lines, str(tmp_path / "a"), max_records=20, gathered=True)
    raw.write_raw(raw.wrap_envelope(*given), str(tmp_path / "b"), max_records=20)
    one, two = (sorted(map(tuple, spark.read.text(str(tmp_path / n)).collect())) for n in "ab")
    assert one == two and len(one) == 95
