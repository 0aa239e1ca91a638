"""Queries with SQL against DuckDB, and the way the entry takes them in."""

import pytest
from oracle_check import compare

from riskloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_result_as_sql(spark, name):
    assert compare(spark, QUERIES[name], ORACLES[name], "/root/testdata/sf0.01") is None


def test_entry_registers_all_operators_and_the_pipeline():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
