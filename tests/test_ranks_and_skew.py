from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronlake.operators import skew, staging
from patronlake.operators.ranks import disc_rank, exact_order_statistics, index_rank

FRACTIONS = (0.0, 0.1, 0.5, 0.65, 0.85, 0.95, 1.0)


@pytest.mark.parametrize("spread", ["distinct", "one value", "hot value", "hot top", "wide"])
@pytest.mark.parametrize("n", [1, 2, 17, 4000])
def test_exact_ranks(spark, spread, n):
    rng = random.Random(f"{spread}{n}")
    draw = {
        "distinct": lambda: rng.random() * 1000,
        "one value": lambda: 7.0,
        "hot value": lambda: rng.choice([5.0, rng.random() * 10, rng.random() * 10]),
        "hot top": lambda: rng.choice([999.0, rng.random() * 999]),
        "wide": lambda: rng.choice([-1, 1]) * 10 ** (rng.random() * 16 - 2),
    }[spread]
    values = [Decimal(f"{draw():.2f}") for _ in range(n)]
    df = spark.createDataFrame(
        [(v,) for v in values] + [(None,)], "x decimal(28,2)"
    ).repartition(5)
    wanted = {f"p{i}": disc_rank(p) for i, p in enumerate(FRACTIONS)}
    wanted |= {f"i{i}": index_rank(p) for i, p in enumerate(FRACTIONS[:-1])}
    row = exact_order_statistics(df, "x", wanted).first()
    values.sort()
    assert [row[f"p{i}"] for i in range(len(FRACTIONS))] == [
        values[max(1, math.ceil(n * p)) - 1] for p in FRACTIONS
    ]
    assert [row[f"i{i}"] for i in range(len(FRACTIONS) - 1)] == [
        values[int(n * p)] for p in FRACTIONS[:-1]
    ]


def test_no_values_no_statistics(spark):
    empty = spark.createDataFrame([], "x int")
    assert exact_order_statistics(empty, "x", {"a": disc_rank(0.5)}).first().a is None
    with pytest.raises(TypeError):
        exact_order_statistics(spark.range(1).selectExpr("1.5D AS x"), "x", {"a": disc_rank(0.5)})


def test_index_and_disc_ranks_differ_by_one_when_whole(spark):
    row = exact_order_statistics(
        spark.range(1, 101), "id", {"index": index_rank(0.65), "disc": disc_rank(0.65)}
    ).first()
    assert (row["index"], row["disc"]) == (66, 65)


def test_spread_left_join_equals_plain_join(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("row_id"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL "
               "WHEN id % 11 = 0 THEN 'lost' ELSE concat('k', id % 500) END").alias("key"),
    )
    lookup = spark.createDataFrame(
        [("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(500)], "key string, value string"
    )
    assert skew.hot_keys(rows, "key").first()[0]["keys"][0] == "hot"
    spread = skew.spread_left_join(rows, lookup, "key", salt_by="row_id")
    plain = rows.join(lookup, "key", "left")
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(
        map(tuple, plain.collect()), key=str
    )


def test_hot_account_is_dealt_out_over_partitions(spark):
    orders = spark.range(4000).select(
        F.col("id").cast("string").alias("order_id"),
        F.expr("CASE WHEN id % 2 = 0 THEN 'c-hot' ELSE concat('c', id) END").alias("customer_id"),
    )
    customers = spark.createDataFrame(
        [("c-hot", "early", 1), ("c-hot", "late", 2)],
        "customer_id string, customer_unique_id string, file_row int",
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        owned = staging.owned_orders(orders, customers).withColumn("part", F.spark_partition_id())
        hot = owned.filter("customer_id = 'c-hot'").cache()
        assert {r.user_id for r in hot.collect()} == {"late"}
        largest = hot.groupBy("part").count().agg(F.max("count")).first()[0]
        assert largest < 0.5 * 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
