"""Operators against brute force on small frames."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.functions import payloads, scalars
from strata.operators import checks, dedup, incremental, quality, quantiles, ranking, scd2, spine
from strata.operators.quality import Rule
from strata.plans import kpis
from strata.sources import tables

T0 = datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


# -- dedup ----------------------------------------------------------------------------------------------------


def test_dedup_keeps_newest_and_every_null_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (None, 5, "x"), (None, 5, "x")], "k int, ts int, v string")
    assert rows(dedup.dedup_latest(df, ["k"], ["ts"])) == [(1, 2, "b"), (2, None, "c"), (None, 5, "x"), (None, 5, "x")]
    assert rows(dedup.dedup_latest(df, ["k"], ["ts"], null_keys="drop")) == [(1, 2, "b"), (2, None, "c")]


def test_dedup_ties_do_not_depend_on_row_order(spark):
    data = [(1, 1, f"v{i}") for i in range(20)]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        picks.add(dedup.dedup_latest(spark.createDataFrame(data, "k int, ts int, v string"), ["k"], ["ts"]).first().v)
    assert len(picks) == 1


def test_dedup_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = dedup.dedup_latest(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    limit, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert "Partial" in plan and exchange < limit  # printed top-down: the partial limit lies below the exchange


# -- quality --------------------------------------------------------------------------------------------------


def test_rules_fail_on_false_and_on_null(spark):
    df = spark.createDataFrame([(1, 5), (None, -1), (2, None)], "id int, n int")
    out = quality.evaluate_rules(df, [Rule("id_known", "id is not null"), Rule("n_positive", "n > 0")])
    assert rows(out, "n", "dq_failed_rules", "is_quarantined") == [
        (-1, ["id_known", "n_positive"], True),
        (5, [], False),
        (None, ["n_positive"], True),
    ]
    good, bad = quality.split_quarantine(out)
    assert rows(good) == [(1, 5)] and bad.count() == 2
    assert rows(quality.rule_summary(out)) == [("id_known", 1), ("n_positive", 2)]


# -- quantiles ------------------------------------------------------------------------------------------------


def test_exact_quantile_equals_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {"hot": rng.normal(0, 50, 3000), "one": [4.25], "two": [-3.5, 10.0], "same": [2.0] * 50, None: [1.0, 5.0, 9.0]}
    data = [(g, round(float(v), 3)) for g, vs in groups.items() for v in vs] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    for p in (0.0, 0.5, 0.99, 1.0):
        got = {r.g: r.q for r in quantiles.exact_quantile(df, ["g"], "v", p, "q").collect()}
        want = {g: np.quantile([v for k, v in data if k == g and v is not None], p) for g in groups}
        assert set(got) == set(want)
        assert all(got[g] == pytest.approx(want[g], abs=1e-6) for g in want)


def test_exact_quantile_of_integers_without_groups(spark):
    df = spark.range(1, 1001).select((F.col("id") * F.col("id")).alias("v"))
    got = quantiles.exact_quantile(df, [], "v", 0.95, "q").first().q
    assert got == pytest.approx(np.quantile(np.arange(1, 1001, dtype="int64") ** 2, 0.95))


@pytest.mark.parametrize(
    "values, kind",
    [
        ([1e-8, 2e-8, 3e-8], "double"),
        ([1e15, 2e15, 3e15, 7e18], "double"),
        ([1.0, 2.0, 3.0, float("nan"), float("nan")], "double"),
        ([-5, 9_007_199_254_740_993, 9_007_199_254_740_995], "long"),
        ([Decimal("0.0000000001"), Decimal("12345678901234567.5"), Decimal("12345678901234567.75")], "decimal(28, 10)"),
    ],
)
def test_exact_quantile_over_every_range(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    for p in (0.0, 0.5, 1.0):
        got = quantiles.exact_quantile(df, [], "v", p, "q").first().q
        at = sorted(map(float, values), key=lambda v: (np.isnan(v), v))
        pos = p * (len(at) - 1)
        low, high = at[int(np.floor(pos))], at[int(np.ceil(pos))]
        assert got == pytest.approx(low + (high - low) * (pos % 1), rel=1e-15, nan_ok=True)


def test_one_outlier_does_not_gather_a_group_in_one_partition(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 7, F.lit(1e18)).otherwise(F.col("id") / 3).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = quantiles.value_counts(df, "v").repartitionByRange(8, "v").withColumn("b", F.spark_partition_id())
        assert counts.groupBy("b").count().agg(F.max("count")).first()[0] < 20_000 / 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert quantiles.exact_median(df, [], "v", "q").first().q == pytest.approx(np.median([1e18 if i == 7 else i / 3 for i in range(20_000)]))


def test_trim_and_histogram(spark):
    df = spark.range(0, 101).select(F.col("id").alias("x"))
    kept = quantiles.quantile_trim(df, "x", 0.9)
    assert kept.agg(F.max("x")).first()[0] == 90
    bins = quantiles.histogram(kept, "x", 9).orderBy("bin").collect()
    assert [b.n_rows for b in bins] == [10] * 8 + [11] and bins[0].bin_from == 0.0 and bins[-1].bin_to == 90.0
    flat = quantiles.histogram(spark.createDataFrame([(3,), (3,)], "x int"), "x", 4).collect()
    assert [(b.bin, b.n_rows) for b in flat] == [(0, 2)]


# -- history --------------------------------------------------------------------------------------------------


def change_log(seed=1, n=400):
    rng = random.Random(seed)
    hot = ["h"] * 5 + ["a", "b", "c"]  # one key holds most rows
    return [(rng.choice(hot), T0 + timedelta(hours=i * 5), rng.choice("xyz"), rng.choice([None, "p"])) for i in range(n)]


def test_history_of_one_key_and_one_day_is_cut_into_parts(spark):
    log = spark.range(3000).select(
        F.lit("k").alias("k"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).alias("ts"), (F.col("id") % 3).alias("v")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = scd2.in_order(log, ["k", "ts"]).groupBy("__part").count().collect()
        assert len(parts) == 3 and max(r["count"] for r in parts) < 2000
        got = scd2.scd2_from_history(log, ["k"], "ts", ["v"])
        assert got.count() == 3000 and got.filter("valid_to is null").count() == 1
        assert got.filter("unix_timestamp(valid_to) - unix_timestamp(valid_from) <> 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_history_from_log_equals_plain_windows(spark):
    log = change_log()
    got = rows(
        scd2.scd2_from_history(spark.createDataFrame(log, "k string, ts timestamp, v string, w string"), ["k"], "ts", ["v", "w"]),
        "k", "v", "w", "valid_from", "valid_to",
    )
    want = []
    for key in {r[0] for r in log}:
        versions = []
        for _, ts, v, w in sorted((r for r in log if r[0] == key), key=lambda r: r[1]):
            if not versions or versions[-1][1:3] != (v, w):
                versions.append((ts, v, w))
        for i, (ts, v, w) in enumerate(versions):
            want.append((key, v, w, ts, versions[i + 1][0] if i + 1 < len(versions) else None))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("strategy", ["timestamp", "check"])
def test_folding_batches_equals_history_in_one_pass(spark, strategy):
    log = change_log(seed=5, n=60)
    df = spark.createDataFrame(log, "k string, ts timestamp, v string, w string")
    target = None
    for start in range(0, 60, 12):
        # one row per key and batch, as a staged load gives
        batch = dedup.dedup_latest(spark.createDataFrame(log[start : start + 12], df.schema), ["k"], ["ts"])
        if strategy == "timestamp":
            target = scd2.scd2_apply(target, batch, ["k"], "timestamp", updated_at="ts")
        else:
            target = scd2.scd2_apply(target, batch, ["k"], "check", check_cols=["v", "w"], as_of=F.col("ts"))
    seen = [r for s in range(0, 60, 12) for r in {r[0]: r for r in log[s : s + 12]}.values()]
    whole = scd2.scd2_from_history(
        spark.createDataFrame(seen, df.schema), ["k"], "ts", None if strategy == "timestamp" else ["v", "w"]
    )
    if strategy == "check":  # as_of is a run time there; here each row brings its own
        assert target.count() == whole.count()
        cols = ("k", "v", "w", "valid_from")
    else:
        cols = ("k", "v", "w", "valid_from", "valid_to", "scd_id")
    assert rows(target, *cols) == rows(whole, *cols)
    assert checks.check_one_current(target, ["k"]).isEmpty()


def test_apply_is_idempotent_and_can_close_deleted_keys(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (None, "z")], "k int, v string")
    day = [F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp") for d in (1, 2, 3)]
    apply = lambda t, s, at, **kw: scd2.scd2_apply(t, s, ["k"], "check", check_cols=["v"], as_of=at, **kw)
    one = apply(None, first, day[0])
    assert rows(apply(one, first, day[1])) == rows(one) and one.count() == 2
    two = apply(one, spark.createDataFrame([(1, None)], "k int, v string"), day[1], hard_deletes="close")
    assert rows(two, "k", "v", F.day("valid_from"), F.day("valid_to")) == [(1, "a", 1, 2), (1, None, 2, None), (2, "b", 1, 2)]
    assert rows(scd2.scd2_as_of(two, F.lit("2024-01-01 12:00:00").cast("timestamp")), "k", "v") == [(1, "a"), (2, "b")]


def test_stored_history_keeps_closed_versions_of_a_repeated_run(spark, tmp_path):
    path, bucket = str(tmp_path / "h"), tables.hash_bucket(["k"], 2)
    load = lambda data, run: tables.snapshot_by_timestamp(
        spark, path, spark.createDataFrame(data, "k int, ts int, v string"), ["k"], "ts", bucket, run
    )
    load([(1, 1, "a"), (2, 1, "b"), (3, 1, "c")], "r1")
    load([(1, 2, "a2")], "r2")
    load([(2, 5, "b2"), (1, 2, "a2")], "r2")
    got = rows(tables.read_table(spark, path), "k", "v", "valid_from", "valid_to")
    assert got == [(1, "a", 1, 2), (1, "a2", 2, None), (2, "b", 1, 5), (2, "b2", 5, None), (3, "c", 1, None)]


# -- increments -----------------------------------------------------------------------------------------------


def test_watermark_filters(spark):
    df = spark.createDataFrame([(i, T0 + timedelta(days=i)) for i in range(10)], "id int, ts timestamp")
    assert incremental.hwm_filter(df, None, "ts").count() == 10
    assert rows(incremental.hwm_filter(df, df.filter("id < 6"), "ts"), "id") == [(6,), (7,), (8,), (9,)]
    assert incremental.hwm_filter(df, df.filter("id < 0"), "ts").count() == 10
    assert rows(incremental.lookback_filter(df, df.filter("id < 9"), "ts", 3), "id") == [(5,), (6,), (7,), (8,), (9,)]


def test_watermark_reaches_the_scan(spark, tmp_path):
    spark.range(100).withColumn("ts", F.col("id")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = df.filter(F.col("ts") > df.filter("id < 50").agg(F.max("ts")).scalar())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,ScalarSubquery" in text


def test_since_filter_rereads_the_overlap(spark):
    df = spark.createDataFrame([("a", T0 + timedelta(minutes=5 * i)) for i in range(5)] + [("b", T0)], "repo string, ts timestamp")
    marks = spark.createDataFrame([("a", T0 + timedelta(minutes=20))], "repo string, boundary timestamp")
    assert rows(incremental.since_filter(df, marks, "repo", "ts").groupBy("repo").count()) == [("a", 3), ("b", 1)]


def test_merge_replaces_inserts_and_never_deletes(spark):
    target = spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], "k int, ts int, v string")
    new = spark.createDataFrame([(2, 4, "B"), (3, 1, "C"), (None, 9, "n")], "k int, ts int, v string")
    assert rows(incremental.merge_upsert(target, new, ["k"])) == [(1, 5, "a"), (2, 4, "B"), (3, 1, "C")]
    assert rows(incremental.merge_upsert(target, new, ["k"], ["ts"])) == [(1, 5, "a"), (2, 5, "b"), (3, 1, "C")]
    assert rows(incremental.merge_upsert(None, new, ["k"])) == [(2, 4, "B"), (3, 1, "C")]


def test_stored_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path, bucket = str(tmp_path / "u"), tables.range_bucket("k", 10)
    tables.upsert_table(spark, path, spark.range(30).select(F.col("id").alias("k"), F.lit(0).alias("v")), ["k"], bucket)
    files = lambda b: {p.name for p in (tmp_path / "u" / f"key_bucket={b}").glob("*.parquet")}
    before = files(0), files(1)
    tables.upsert_table(spark, path, spark.createDataFrame([(12, 7), (31, 7)], "k bigint, v int"), ["k"], bucket)
    assert files(0) == before[0] and files(1) != before[1]
    got = tables.read_table(spark, path)
    assert got.count() == 31 and rows(got.filter("v = 7"), "k") == [(12,), (31,)]


def test_dedup_since_equals_dedup_then_filter(spark):
    rng = random.Random(2)
    data = [(rng.choice([1, 1, 1, 2, 3, 4, None]), rng.randint(0, 50), rng.randint(0, 50), i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, upd int, ing int, i int")
    target = df.filter("ing < 30")
    got = incremental.dedup_since(df, target, ["k"], ["upd", "ing"], "ing")
    want = dedup.dedup_latest(df, ["k"], ["upd", "ing"]).filter("ing > 29")
    assert rows(got) == rows(want)


# -- spine, ranking, checks, payloads ---------------------------------------------------------------------------


def test_calendar_and_month_spine(spark):
    bounds = spark.sql("select date'2023-12-30' as start, date'2024-02-02' as end")
    days = spine.date_dim(bounds)
    assert days.count() == 35
    first = days.orderBy("date_key").first()
    assert (first.date_key, first.quarter, first.week_of_year, first.day_of_week) == (20231230, 4, 52, 7)
    limits = kpis.limits(bounds)
    months = spine.densify(spark.createDataFrame([(1,)], "r int"), limits.getField("start"), limits.getField("end"))
    assert rows(months) == [(1, "2023-12"), (1, "2024-01"), (1, "2024-02")]


def test_zero_fill_and_top_k(spark):
    counts = spark.createDataFrame([("b", 2), ("other", 9)], "c string, n bigint")
    assert rows(spine.zero_fill(counts, ["a", "b"], "c", "n")) == [(0, "a", 0), (1, "b", 2)]
    best = ranking.top_k(spark.createDataFrame([(1, 5), (2, None), (3, 5), (4, 1)], "id int, n int"), "n", 2, ["id"])
    assert [r.id for r in best.collect()] == [1, 3]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()


def test_checks_return_the_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4)], "k int, p int")
    assert rows(checks.check_not_null(df, "k"), "p") == [(3,), (4,)]
    assert rows(checks.check_unique(df, ["k"])) == [(1, 2)]
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(checks.check_relationship(df, "p", parent, "id"), "p") == [(3,), (4,)]


def test_map_unpivot_and_checksum(spark):
    df = spark.createDataFrame([(1, '{"C++": 5, "Go": 1}'), (2, "{}"), (3, "{broken")], "id int, data string")
    assert rows(payloads.explode_map(df, "data", "language", "bytes")) == [(1, "C++", 5), (1, "Go", 1)]
    one = df.select(payloads.payload_checksum(["id", "data"]).alias("c"))
    assert rows(one) == rows(df.select(payloads.payload_checksum(["data", "id"]).alias("c")))


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("a/b", 20240229, T0, T0 + timedelta(seconds=5400, microseconds=900000))], "n string, k int, s timestamp, e timestamp")
    got = df.select(
        scalars.short_name("n"), scalars.repo_slug("n"), scalars.month_of_key("k"), scalars.date_key("s"),
        scalars.hours_between("s", "e").cast("double"), scalars.date_key(scalars.day_of_key("k")),
        scalars.ratio(F.lit(1), F.lit(0)), scalars.contributor_label(F.lit("u"), "n"),
    ).first()
    assert tuple(got) == ("b", "a_b", "2024-02", 20240101, 1.5, 20240229, None, "u · b")


def test_contributions_of_unknown_users(spark):
    issues = spark.createDataFrame([(1, 7, 2), (1, None, 3)], "repo_id int, author_user_id int, comment_count int")
    prs = spark.createDataFrame([(1, 7, 20240101, 4, 10, 1)], "repo_id int, author_user_id int, merged_date_key int, comment_count int, additions int, deletions int")
    repos = spark.createDataFrame([(1, "o/r", True)], "repo_id int, repo_name string, is_current boolean")
    users = spark.createDataFrame([(7, "ada")], "user_id int, user_login string")
    kept = kpis.kpi_user_contributions(issues, prs, repos, users)
    assert rows(kept, "user_id", "total_issues_opened", "total_comments") == [(7, 1, 6), (None, 0, 0)]
    counted = kpis.kpi_user_contributions(issues, prs, repos, users, null_safe=True)
    assert rows(counted, "user_id", "total_issues_opened", "total_comments") == [(7, 1, 6), (None, 1, 3)]


def test_size_buckets(spark):
    df = spark.createDataFrame([(0,), (99,), (100,), (499,), (500,), (999,), (1000,), (None,)], "n int")
    got = [r.b for r in df.select(kpis.size_bucket(F.col("n")).alias("b")).collect()]
    assert got == ["Small", "Small", "Medium", "Medium", "Large", "Large", "XL", "Unknown"]
