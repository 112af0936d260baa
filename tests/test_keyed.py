"""Tables merged by key: only touched buckets are written, and no old row is shuffled."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlake.sources import keyed
from patronlake.sources.tables import NullViolation

SCHEMA = T.StructType([
    T.StructField("user", T.StringType(), False), T.StructField("part", T.StringType(), False),
    T.StructField("n", T.IntegerType(), True),
])


@pytest.fixture
def table(spark):
    name = f"keyed_{uuid.uuid4().hex}"
    yield keyed.KeyedTable(spark, name, "t", SCHEMA, "user", ("user", "part"), buckets=16, generations=4)
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def batch(spark, rows, gone=()):
    frame = spark.createDataFrame([(*r, tuple(r[:2]) in gone) for r in rows], "user string, part string, n int, __gone boolean")
    return frame.repartition(3)


def content(table):
    return {(r.user, r.part): r.n for r in table.read().collect()}


def files(table):
    rows = table.read().select("user", F.input_file_name().alias("file")).distinct().collect()
    return {r.user: r.file for r in rows}


def test_merges_equal_a_dictionary(spark, table):
    draw, expected = random.Random(1), {}
    for turn in range(9):
        rows = {(f"u{draw.randrange(40)}", f"p{draw.randrange(3)}"): draw.randrange(100) for _ in range(draw.choice([3, 30]))}
        gone = {k for k in rows if draw.random() < 0.3}
        result = table.merge(batch(spark, [(*k, n) for k, n in rows.items()], gone))
        expected = {k: n for k, n in {**expected, **rows}.items() if k not in gone}
        assert content(table) == expected and result.version == turn + 1
        assert len(table._state()[1]) <= 4


def test_untouched_buckets_keep_their_files(spark, table):
    table.merge(batch(spark, [(f"u{i}", "p", i) for i in range(200)]))
    before = files(table)
    result = table.merge(batch(spark, [("u7", "p", -1), ("u7", "q", 5)]))
    after = files(table)
    assert result.buckets == 1
    moved = {u for u in before if before[u] != after[u]}
    own = {u for u in before if before[u] == before["u7"]}
    assert moved == own and 0 < len(own) < 60
    assert content(table)["u7", "p"] == -1 and len(content(table)) == 201


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_over_stored_rows(spark, table):
    table.merge(batch(spark, [(f"u{i}", "p", i) for i in range(200)]))
    table.merge(batch(spark, [(f"u{i}", "p", i) for i in range(5)]))
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = batch(spark, [("u1", "p", 3), ("u90", "p", 3)])
        touched = set(table.stage(new))
        assert touched == table._buckets_of(new)
        plan = plan_of(table.merged(touched))
        assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan  # the batch
        assert "PartitionFilters: [isnotnull(bucket" in plan
        found = table.rows_of(new)
        scans = [line for line in plan_of(found).splitlines() if "FileScan parquet" in line]
        assert scans and all("PartitionFilters: [isnotnull(bucket" in line for line in scans)
        assert sorted((r.user, r.n) for r in found.collect()) == [("u1", 1), ("u90", 90)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_a_crash_before_the_switch_changes_nothing(spark, table, monkeypatch):
    table.merge(batch(spark, [("a", "p", 1), ("b", "p", 2)]))
    before = content(table)

    def die(self, version, owners):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patched:
        patched.setattr(keyed.KeyedTable, "_publish", die)
        with pytest.raises(RuntimeError):
            table.merge(batch(spark, [("a", "p", 9), ("c", "p", 3)]))
    assert content(table) == before and table._stored_generations() == {1, 2}
    table.merge(batch(spark, [("a", "p", 9)]))
    assert content(table) == {("a", "p"): 9, ("b", "p"): 2}


def test_empty_batches_repeated_keys_and_nulls(spark, table):
    assert table.read().count() == 0 and table.merge(batch(spark, [])).skipped
    table.merge(batch(spark, [("a", "p", 1), ("a", "p", 4), ("a", "q", None)]))
    assert content(table) == {("a", "p"): 4, ("a", "q"): None}
    assert table.merge(batch(spark, [])).skipped and content(table) == {("a", "p"): 4, ("a", "q"): None}
    with pytest.raises(NullViolation):
        table.merge(batch(spark, [(None, "p", 1)]))
    assert table.rows_of(batch(spark, [("zz", "p", 1)])).count() == 0


def test_what_a_merge_replaces_stays_readable_for_one_more(spark, table):
    table.merge(batch(spark, [("a", "p", 1)]))
    reader = table.read()
    reader.schema  # planned before the next merge
    table.merge(batch(spark, [("a", "p", 2)]))
    assert 1 in table._stored_generations()
    table.merge(batch(spark, [("a", "p", 3)]))
    assert content(table) == {("a", "p"): 3}


def test_a_first_merge_evaluates_its_batch_once_and_stages_nothing(spark, table, monkeypatch):
    evaluated = spark.sparkContext.accumulator(0)

    def told(n):
        evaluated.add(1)
        return n

    rows = batch(spark, [("a", "p", 1), ("a", "p", 4), ("b", "p", 2), ("c", "p", 3)], {("c", "p")})
    with monkeypatch.context() as patched:
        patched.delattr(keyed.KeyedTable, "stage")
        result = table.merge(rows.withColumn("n", F.udf(told, "int")("n")))
    assert evaluated.value == 4 and (result.version, result.buckets) == (1, 16)
    assert content(table) == {("a", "p"): 4, ("b", "p"): 2}


def test_a_first_merge_with_nulls_stops_and_one_of_deletions_leaves_an_empty_table(spark, table):
    for rows, gone in (([("a", "p", 1), (None, "p", 1)], ()), ([("a", None, 1)], {("a", None)})):
        with pytest.raises(NullViolation):
            table.merge(batch(spark, rows, gone))
        assert not table.exists() and content(table) == {}
    assert table.merge(batch(spark, [("a", "p", 1)], {("a", "p")})).version == 1
    assert table.exists() and content(table) == {}
    table.merge(batch(spark, [("b", "p", 2)]))
    assert content(table) == {("b", "p"): 2}
