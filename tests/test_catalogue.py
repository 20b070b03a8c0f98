"""Every registered query against DuckDB on the driver's tables."""

import pytest
from oracle import assert_same, connect

from __spark_entry__ import entry, oracle_sql, queries
from catalogue import ENTRIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_matches_oracle(spark, con, name):
    assert assert_same(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) > 0


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["department", "job", "Q1", "Q2", "Q3", "Q4"]
    assert result.count() == 429
