import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def hostile(spark):
    """Hostile rows with extra columns whose names the operators use inside."""
    rows = [(i, t, "en", 3, "x", 1.0, b"k", 5) for i, t in brute.hostile_rows()]
    schema = "doc_id long, text string, lang string, n_chars long, quality string, row double, class binary, batch long"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(hostile):
    return hostile.limit(0)
