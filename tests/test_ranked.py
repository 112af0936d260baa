"""Pages by rank: the same rows as a sort, from the ranges that hold them, at any offset."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from patronlake.sources import ranked

ORDER = [("value", True), ("id", False)]


@pytest.fixture
def table(spark):
    name = f"ranked_{uuid.uuid4().hex}"
    yield ranked.RankedTable(spark, name, "t", ORDER, rows_per_range=50)
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def rows_of(n, seed=1):
    draw = random.Random(seed)
    # a third of the rows share one value, some have none
    return [(f"u{i:04}", draw.choice([None, 7, draw.randrange(100)]), i) for i in range(n)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, value int, n int").repartition(5)


def plain(df):
    return [(r["id"], r["value"], r["n"]) for r in df.collect()]


def test_pages_equal_a_sort(spark, table):
    rows = rows_of(730)
    assert table.load(frame(spark, rows)) == 730 and table.count() == 730
    expected = in_order(rows)
    for offset, limit in [(0, 10), (45, 10), (49, 200), (700, 100), (729, 1), (730, 5), (9999, 5), (3, 0), (0, 1000)]:
        page = table.page(offset, limit)
        assert plain(page) == expected[offset:offset + limit]
        assert [r[ranked.RANK] for r in page.collect()] == list(range(offset, min(730, offset + limit)))


def test_positions_and_walks(spark, table):
    rows = rows_of(300)
    table.load(frame(spark, rows))
    expected = in_order(rows)
    for values in [(7,), (None,), (1000,), (-1,), (7, "u0100"), (None, "u0003"), (None, "zz")]:
        def key(row):
            return (row[1] is None, -(row[1] or 0), row[0])[: 2 if len(values) == 1 else 3]

        bound = (values[0] is None, -(values[0] or 0), *values[1:])
        assert table.position(values) == sum(key(r) < bound for r in expected), values
        assert table.position(values, after=True) == sum(key(r) <= bound for r in expected), values
    walked, at = [], None
    while page := plain(table.page(0, 64) if at is None else table.after(at, 64)):
        walked += page
        at = (page[-1][1], page[-1][0])
    assert walked == expected
    page = table.page_from((7,), 5, 10)
    start = table.position((7,))
    assert plain(page) == expected[start + 5:start + 15]
    assert {(r["total"], r["has_more"]) for r in page.collect()} == {(300 - start, start + 15 < 300)}


def test_a_page_reads_its_ranges_alone(spark, table):
    table.load(frame(spark, rows_of(2000)))
    files = table.spark.table(table._rows(1)).inputFiles()
    assert len(files) > 20

    def opened(page):
        plan = page._jdf.queryExecution().executedPlan()
        page.collect()
        text = plan.toString()
        assert "PartitionFilters" in text and ranked.PLACE in text.split("PushedFilters")[1]
        return len(set(r["f"] for r in page.select(F.input_file_name().alias("f")).collect()))

    early, late = opened(table.page(10, 20)), opened(table.page(1900, 20))
    assert early <= 2 and late <= 2


def test_a_load_that_dies_changes_nothing(spark, table, monkeypatch):
    table.load(frame(spark, rows_of(100)))
    before = plain(table.page(0, 100))
    with monkeypatch.context() as m:
        m.setattr(table, "_write_directory", lambda version: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.load(frame(spark, rows_of(60, seed=2)))
    assert table.version() == 1 and plain(table.page(0, 100)) == before
    assert table.load(frame(spark, rows_of(60, seed=2))) == 60
    assert table.version() == 2 and plain(table.page(0, 100)) == in_order(rows_of(60, seed=2))
    assert len(spark.catalog.listTables(table.database)) == 5  # two versions, two directories, the view


def test_empty_equal_and_clashing(spark, table):
    assert table.load(frame(spark, rows_of(30)).limit(0)) == 0
    assert table.count() == 0 and plain(table.page(0, 5)) == [] and table.position((7,)) == 0
    same = [("u", 1, 2)] * 120
    table.load(frame(spark, same))
    assert plain(table.page(60, 100)) == same[:60] and table.position((1, "u"), after=True) == 120
    with pytest.raises(ValueError):
        table.load(frame(spark, same).withColumn(ranked.RANK, F.lit(1)))
    with pytest.raises(ValueError):
        table.page(-1, 5)
    with pytest.raises(ValueError):
        table.position(())
