"""Change feeds, stopped writes, deleted keys, versions of whole tables."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.scd2 import scd2_apply
from strata.plans.daily import Options, Warehouse
from strata.sources import changes, tables, versions
from strata.sources.changes import ChangeLog, merge_logged, snapshot_logged, upsert_logged

KINDS = "k int, updated_at int, v int"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def files_read(df):
    return {f.split("key_bucket=")[1].split("/")[0] for f in df.inputFiles()}


def batch(spark, *records):
    return spark.createDataFrame(list(records), KINDS)


def test_upserts_leave_before_and_after(spark, tmp_path):
    path, bucket = str(tmp_path / "t"), F.col("k") % 3
    one = upsert_logged(spark, path, batch(spark, (1, 1, 10), (2, 1, 20), (3, 1, 30)), ["k"], bucket, ["updated_at"], {"a": 1})
    two = upsert_logged(spark, path, batch(spark, (1, 2, 11), (2, 0, 99), (5, 1, 50), (None, 9, 9)), ["k"], bucket, ["updated_at"], {"b": 2})
    assert (one, two) == (1, 2)
    assert rows(tables.read_table(spark, path), "k", "v") == [(1, 11), (2, 20), (3, 30), (5, 50)]
    log = ChangeLog(spark, path)
    assert rows(log.since(1), "change", "k", "v") == [("after", 1, 11), ("after", 5, 50), ("before", 1, 10)]
    assert log.since(2) is None and log.since(0).count() == 6
    assert log.marks() == {"a": 1, "b": 2}
    log.forget(1)
    assert log.since(0).count() == 3 and log.marks() == {"a": 1, "b": 2}
    log.forget(2)
    assert log.since(0) is None and log.newest() == 2 and log.marks() == {"a": 1, "b": 2}


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    path, bucket = str(tmp_path / "t"), F.col("k") % 5
    upsert_logged(spark, path, batch(spark, *[(k, 1, k) for k in range(20)]), ["k"], bucket)
    before = set(spark.read.parquet(path).inputFiles())
    upsert_logged(spark, path, batch(spark, (7, 2, 70)), ["k"], bucket)
    same = before & set(spark.read.parquet(path).inputFiles())
    assert {f.split("key_bucket=")[1][0] for f in same} == set("0134")


@pytest.mark.parametrize("step", ["plan", "table", "commit"])
def test_a_stopped_write_is_finished_or_undone(spark, tmp_path, monkeypatch, step):
    """Wherever a write stops, the next one gives the table and the feed of an undisturbed run."""
    path, bucket = str(tmp_path / "t"), F.col("k") % 3
    upsert_logged(spark, path, batch(spark, (1, 1, 10), (2, 1, 20)), ["k"], bucket)

    class Stop(Exception):
        pass

    def stop(*_, **__):
        raise Stop

    real, calls = changes.write_text, []

    def write(s, p, text):
        calls.append(p)
        if (step == "plan") == p.endswith(".planned") or (step == "commit" and p.endswith(".committed")):
            raise Stop
        real(s, p, text)

    with monkeypatch.context() as m:
        if step in ("plan", "commit"):
            m.setattr(changes, "write_text", write if step == "plan" else lambda s, p, t: stop() if p.endswith(".committed") else real(s, p, t))
        elif step == "table":
            m.setattr(changes, "_replace", stop)
        else:
            m.setattr(changes.ChangeLog, "write", stop)
        with pytest.raises(Stop):
            upsert_logged(spark, path, batch(spark, (1, 2, 11), (4, 1, 40)), ["k"], bucket)
    upsert_logged(spark, path, batch(spark, (1, 2, 11), (4, 1, 40), (5, 1, 50)), ["k"], bucket)
    assert rows(tables.read_table(spark, path), "k", "v") == [(1, 11), (2, 20), (4, 40), (5, 50)]
    feed = ChangeLog(spark, path).since(0)
    signed = feed.groupBy("k", "v").agg(F.sum(F.when(F.col("change") == "after", 1).otherwise(-1)).alias("n")).filter("n <> 0")
    assert rows(signed, "k", "v", "n") == [(1, 11, 1), (2, 20, 1), (4, 40, 1), (5, 50, 1)]


def test_sums_take_deltas_and_rows_go_at_zero(spark, tmp_path):
    path = str(tmp_path / "t")

    def add(*deltas):
        df = spark.createDataFrame(list(deltas), "a int, b string, n long")

        def merged(o, n):
            total = F.coalesce(o.getField("n"), F.lit(0)) + n.getField("n")
            return F.when(total != 0, n.withField("n", total))

        merge_logged(spark, path, df, ["a", "b"], F.col("a") % 2, merged)

    add((1, None, 2), (2, "x", 3))
    add((1, None, -1), (2, "x", -3), (3, "y", 1))
    assert rows(tables.read_table(spark, path), "a", "b", "n") == [(1, None, 1), (3, "y", 1)]


def snapshots(spark, path, seed, **how):
    """Random batches applied to a logged history and, in one piece, to a frame."""
    rnd, whole = random.Random(seed), None
    for day in range(1, 4):
        keys = rnd.sample(range(12), 6 if how.get("hard_deletes") != "close" else 9)
        given = batch(spark, *[(k, rnd.choice([day, day - 1, 1]), rnd.randint(0, 2)) for k in keys])
        plain = dict(how, as_of=F.lit(100 + day))
        snapshot_logged(spark, path, given, ["k"], F.col("k") % 4, **plain)
        strategy = plain.pop("strategy")
        whole = scd2_apply(whole, given, ["k"], strategy, **plain)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
    return whole


@pytest.mark.parametrize(
    "how",
    [
        {"strategy": "timestamp", "updated_at": "updated_at"},
        {"strategy": "timestamp", "updated_at": "updated_at", "refresh": ["v"]},
        {"strategy": "check", "check_cols": ["v"]},
        {"strategy": "check", "check_cols": ["v"], "hard_deletes": "close"},
        {"strategy": "timestamp", "updated_at": "updated_at", "hard_deletes": "close", "refresh": ["v"]},
    ],
)
def test_logged_history_equals_the_frames(spark, tmp_path, how):
    path = str(tmp_path / "h")
    cols = ["k", "v", "updated_at", "valid_from", "valid_to"]
    if "check_cols" in how:
        cols.remove("updated_at")  # not a column that opens a version
    if how.get("hard_deletes") == "close" and "refresh" in how:
        cols.remove("v")  # a refresh that only changes v may lie in a bucket whose digest is the same
    whole = snapshots(spark, path, 3, **how)
    assert rows(tables.read_table(spark, path), *cols) == rows(whole, *cols)
    feed = ChangeLog(spark, path).since(0)
    assert feed.filter("change = 'opened'").count() == whole.count()
    assert feed.filter("change = 'closed'").count() == whole.filter("valid_to is not null").count()


def test_deleted_keys_close_and_like_buckets_stay_shut(spark, tmp_path):
    path, bucket = str(tmp_path / "h"), F.col("k") % 4
    how = {"strategy": "check", "check_cols": ["v"], "hard_deletes": "close"}
    snapshot_logged(spark, path, batch(spark, *[(k, 1, k) for k in range(8)]), ["k"], bucket, as_of=F.lit(1), **how)
    kept = set(spark.read.parquet(path).inputFiles())
    # 5 is gone, 6 has changed
    after = [(k, 1, 60 if k == 6 else k) for k in range(8) if k != 5]
    snapshot_logged(spark, path, batch(spark, *after), ["k"], bucket, as_of=F.lit(2), **how)
    assert rows(tables.read_table(spark, path).filter("valid_to is not null"), "k", "v", "valid_to") == [(5, 5, 2), (6, 6, 2)]
    assert files_read(spark.read.parquet(path).filter("valid_to is null")) >= set("0123")
    still = kept & set(spark.read.parquet(path).inputFiles())
    assert {f.split("key_bucket=")[1][0] for f in still} == set("03")
    # a bucket whose keys are all gone
    snapshot_logged(spark, path, batch(spark, *[a for a in after if a[0] % 4]), ["k"], bucket, as_of=F.lit(3), **how)
    assert rows(tables.read_open(spark, path), "k") == [(1,), (2,), (3,), (6,), (7,)]
    assert rows(tables.read_table(spark, path).filter("valid_to = 3"), "k") == [(0,), (4,)]


def test_a_table_is_never_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.overwrite_table(spark.range(3).toDF("k"), path)
    folder = versions.write_version(spark.range(5).toDF("k"), path)  # the job dies here
    assert tables.read_table(spark, path).count() == 3
    versions.commit_version(spark, folder)
    old = tables.read_table(spark, path)
    assert old.count() == 5
    versions.overwrite_table(old.filter("k > 0"), path)  # derived from the version before
    assert tables.read_table(spark, path).count() == 4 and old.count() == 5
    versions.overwrite_table(spark.range(1).toDF("k"), path)
    left = sorted(p.name for p in (tmp_path / "t" / "_versions").iterdir() if p.is_dir())
    assert left == ["0000000003", "0000000004"]


@pytest.mark.parametrize("large", [False, True])
def test_what_a_feed_holds_is_not_written_again(spark, tmp_path, monkeypatch, large):
    """One write's changes go on without a window and without a copy; a large write is not shuffled once more by bucket."""
    w, key, staged = Warehouse(spark, str(tmp_path / "w"), Options(buckets=3)), "k", []
    real, plain = changes._written, changes.replace_partitions
    gathered = []
    monkeypatch.setattr(changes, "_written", lambda df, path: staged.append(path) or real(df, path))
    monkeypatch.setattr(changes, "replace_partitions", lambda df, path, by, gather, *more: gathered.append(gather) or plain(df, path, by, gather, *more))
    if large:
        monkeypatch.setattr(changes, "LARGE_BYTES", 1)
    for at, records in enumerate(([(1, 1, 10), (2, 1, 20), (3, 1, 30)], [(2, 2, 21), (4, 2, 40)]), 1):
        w.upsert("source", batch(spark, *records), key, ["updated_at"])
        rows_now, mark = w.latest("source", "copy", [key], [])
        assert "Window" not in rows_now._jdf.queryExecution().executedPlan().toString() and mark == {"source": at}
        staged.clear()
        w.upsert("copy", rows_now, key, marks=mark, stored=True)
        snapshot_logged(spark, w.path("history"), rows_now, [key], w.bucket(key), "timestamp", "updated_at", stored=True)
        assert len(staged) == 2 and all("/_changes/" in p for p in staged)
    assert rows(w.read("copy"), "k", "v") == [(1, 10), (2, 21), (3, 30), (4, 40)]
    assert rows(ChangeLog(spark, w.path("copy")).since(1), "change", "k", "v") == [("after", 2, 21), ("after", 4, 40), ("before", 2, 20)]
    assert rows(w.read("history").filter("valid_to is null"), "k", "v") == [(1, 10), (2, 21), (3, 30), (4, 40)]
    assert rows(w.read("history").filter("valid_to is not null"), "k", "v", "valid_to") == [(2, 20, 2)]
    assert gathered == [not large] * 6
    # several writes at once are compared
    w.upsert("source", batch(spark, (2, 3, 22)), key, ["updated_at"])
    w.upsert("source", batch(spark, (2, 4, 23)), key, ["updated_at"])
    assert rows(w.latest("source", "copy", [key], [])[0], "k", "v") == [(2, 23)]
