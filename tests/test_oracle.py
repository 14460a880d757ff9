"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the flagship entry at sf0.001."""

import os

import pytest

from __spark_entry__ import entry
from rawhouse.plans.oracle import SQL
from rawhouse.plans.queries import REGISTRY
from oracle_harness import compare, duckdb_conn

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(SQL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF, name, con)
    assert ok, msg


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["stock", "period", "period_start_date", "period_end_date", "trend"]
    assert df.count() >= 0
