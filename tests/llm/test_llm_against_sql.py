"""Queries of the package that have SQL, on whole tables."""

from __future__ import annotations

import os

import pytest

from compare import differences, sql_connection
from patronlake.llm.queries import llm_queries
from patronlake.llm.statements import llm_statements

DIRECTORY = os.environ.get("PATRONLAKE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(llm_statements()))
def test_query_equals_sql(spark, key):
    con = sql_connection(DIRECTORY)
    assert differences(llm_queries()[key](spark, DIRECTORY), llm_statements()[key], con) == []
