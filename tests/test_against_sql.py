"""Every registered query against the same question in SQL, on whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from patronlake.oracle import oracle_statements
from patronlake.registry import bound_queries
from compare import differences, sql_connection

DIRECTORY = os.environ.get("PATRONLAKE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, STATEMENTS = bound_queries(), oracle_statements()


@pytest.fixture(scope="module")
def con():
    return sql_connection(DIRECTORY)


def test_each_statement_has_a_query():
    assert set(STATEMENTS) == set(QUERIES)


def test_contract_has_all_queries():
    assert set(QUERIES) <= set(contract.queries()) and set(STATEMENTS) <= set(contract.oracle_sql())


@pytest.mark.parametrize("key", sorted(STATEMENTS))
def test_query_equals_sql(spark, con, key):
    assert differences(QUERIES[key](spark, DIRECTORY), STATEMENTS[key], con) == []


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns[0] == "user_id" and rows.count() > 0
