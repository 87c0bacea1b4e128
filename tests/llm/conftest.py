import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import ODD, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with columns of names that operators use themselves."""
    from pyspark.sql import functions as F

    names = "node component star label score bucket key kept copies n_tokens doc shingles n_sentences ids start block".split()
    return spark.createDataFrame(ODD, SCHEMA).withColumns({n: F.lit(7) for n in names})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(1, 1, 0), (1, 0, None), (5, 0, 1), (None, 1, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
