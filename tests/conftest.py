import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import landing  # noqa: E402

from strata.plans.daily import Options, Warehouse, run_day  # noqa: E402
from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "3",
            "spark.driver.memory": "6g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def sf():
    return os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def warehouse(spark, tmp_path_factory):
    """The three landed days, processed one after the other; what was seen on the way; the root folder."""
    root = str(tmp_path_factory.mktemp("daily"))
    raw, w = f"{root}/raw", Warehouse(spark, f"{root}/wh", Options(buckets=3))
    seen, after_two = {}, {}
    for day, content in zip(landing.DAYS, (landing.day_one(), landing.day_two(), landing.day_three())):
        landing.land(raw, day, content)
        marks = spark.createDataFrame([("octo/alpha", f"{day}T00:00:00Z")], "repo string, boundary string")
        seen[day] = run_day(spark, raw, w, day, f"{day} 02:00:00", boundaries=marks, export_path=f"{root}/export").collect()
        if day == landing.DAYS[1]:
            facts = w.read("gold/fact_pull_requests").select("pr_id", "additions")
            sizes = w.read("gold/kpi_pr_complexity").select("pr_id", "pr_size_bucket")
            versions = w.read("history/pull_requests").groupBy("pull_request_id").count()
            after_two = {n: {r[0]: r[1] for r in df.collect()} for n, df in (("facts", facts), ("sizes", sizes), ("versions", versions))}
    seen["after day two"] = after_two
    return w, seen, root
