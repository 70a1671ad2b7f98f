"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from millrace.workload import REGISTRY
from tools.compare import compare, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with oracle(FOLDER) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_its_sql(spark, connection, name):
    query = REGISTRY[name]
    _, difference = compare(query.plan(spark, FOLDER), connection, query.sql)
    assert difference is None


def test_contract(spark):
    assert contract.queries().keys() >= REGISTRY.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).columns == ["event_type", "value", "user_id", "number_of_rows", "ts"]
    assert contract.entry(spark).count() == 4
