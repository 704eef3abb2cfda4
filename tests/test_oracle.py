"""Every query with an oracle equals DuckDB on the same tables (exact values, sorted columns)."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, SF, verbose=False)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["Lga", "Year", "Type"]
