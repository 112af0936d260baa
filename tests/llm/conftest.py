from __future__ import annotations

import pytest


@pytest.fixture
def table(spark):
    """A DataFrame of rows (doc_id, text), spread over a few partitions."""

    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema).repartition(3)

    return make
