"""Left join whose hot keys are spread over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than 1/200 of the rows is hot, so there are fewer than 200 of them. It is dealt out to
# as many salts as bring it down to about ROWS_PER_TASK rows each; the lookup grows by that many rows,
# at most one for each ROWS_PER_TASK rows and SALTS for each hot key.
HOT_SHARE = 200
SALTS = 64
ROWS_PER_TASK = 1_000_000
_TRACKED = 10_000


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """One row (keys, counts) as a struct of arrays, from one mergeable sketch of the key column."""
    top = rows.agg(
        F.count("*").alias("n"),
        F.expr(f"approx_top_k(`{key}`, {HOT_SHARE}, {_TRACKED})").alias("top"),
    )
    hot = top.select(F.expr(f"filter(top, t -> t.count * {HOT_SHARE} > n)").alias("hot"))
    return hot.select(F.expr("struct(transform(hot, t -> t.item) AS keys, transform(hot, t -> t.count) AS counts)"))


def spread_left_join(
    rows: DataFrame, lookup: DataFrame, key: str, salt_by: str
) -> DataFrame:
    """``rows`` left join ``lookup`` on ``key``, whatever share of the rows one key holds.

    Rows of hot keys and of the NULL key are dealt out by a hash of ``salt_by``; the lookup rows of
    hot keys are repeated once per salt. A key the sketch takes for hot, or misses, changes only
    where its rows are joined. Where a lookup is itself an aggregate, adaptive execution does not
    split its skewed partitions, which is why this is done here.
    """
    hot = hot_keys(rows, key).scalar()
    found = F.get(hot["counts"], (F.array_position(hot["keys"], F.col(key)) - 1).cast("int"))
    salts: Column = F.greatest(F.lit(SALTS), F.ceil(found / ROWS_PER_TASK)).cast("bigint")
    whole = F.xxhash64(salt_by)
    # a NULL key meets nothing, so its rows may go anywhere
    dealt = F.when(F.col(key).isNull(), whole).when(found.isNotNull(), F.pmod(whole, salts))
    one = F.lit(0).cast("bigint")
    salted_rows = rows.withColumn("__salt", F.coalesce(dealt, one))
    all_salts = F.when(found.isNotNull(), F.sequence(one, salts - 1)).otherwise(F.array(one))
    salted_lookup = lookup.withColumn("__salt", F.explode(all_salts))
    return salted_rows.join(salted_lookup, [key, "__salt"], "left").drop("__salt")
