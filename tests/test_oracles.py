"""Every query with SQL runs in Spark and in DuckDB on the same tables."""

import os

import pytest
from oracle_check import compare

from riskloom.plans.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")  # all one-hot values occur here


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_result_as_sql(spark, name):
    assert compare(spark, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 100
