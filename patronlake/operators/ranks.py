"""Exact order statistics without sorting everything in one place."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rank = Callable[[Column], Column]

# Bits of the value settled per step. A step ranks at most 2^22 buckets per wanted rank.
_STEP_BITS = 21
_SHIFTS = (2 * _STEP_BITS, _STEP_BITS, 0)


def disc_rank(fraction: float) -> Rank:
    """1-based rank of ``percentile_disc``: the first value that covers the fraction."""
    return lambda n: F.greatest(F.ceil(n * F.lit(fraction)), F.lit(1)).cast("bigint")


def index_rank(fraction: float) -> Rank:
    """1-based rank of the element at 0-based index ``int(n · fraction)`` of the sorted values."""
    return lambda n: (F.floor(n * F.lit(fraction)) + 1).cast("bigint")


def _whole_number(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return (column * F.lit(10**kind.scale)).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    raise TypeError(f"ranks are taken of whole numbers and decimals, not {kind.simpleString()}")


def exact_order_statistics(
    values: DataFrame, column: str, wanted: Mapping[str, Rank]
) -> DataFrame:
    """One row with the exact value at each wanted rank; NULLs are not ranked.

    The value is found from its leading bits on, as in a radix search. Each step counts the values
    per bucket of equal leading bits, within the buckets the step before has settled on, and runs
    along the counts to the bucket that holds the rank. The counting is an ordinary aggregation with
    partial sums before the shuffle; the running total sees buckets, whose number is bounded by the
    bits of a step and does not grow with the data. A value shared by a third of the rows is one
    bucket like any other.
    """
    kind = values.schema[column].dataType
    rows = values.select(
        F.col(column).alias("v"), _whole_number(F.col(column), kind).alias("whole")
    ).filter(F.col("v").isNotNull())

    found = None
    for shift in _SHIFTS:
        bucket = F.shiftright("whole", shift).alias("bucket")
        if found is None:
            counted = rows.select("v", F.struct(F.lit(0).cast("bigint").alias("within"), bucket).alias("k"))
            targets = []
        else:
            # Rows outside the settled buckets fold into one NULL group per task.
            settled = F.shiftright("whole", shift + _STEP_BITS)
            at = [F.col(f"t.{name}.bucket") for name in wanted]
            kept = F.when(settled.isin(*at), F.struct(settled.alias("within"), bucket))
            counted = rows.withColumn("t", found.scalar()).select("v", "t", kept.alias("k"))
            targets = [
                F.max(f"t.{name}.{part}").alias(f"{name}_{part}")
                for name in wanted for part in ("bucket", "left")
            ]
        counts = counted.groupBy("k.within", "k.bucket").agg(
            F.count("*").alias("c"), F.min("v").alias("v"), *targets
        )
        inside = W.partitionBy("within")
        added = {"upto": F.sum("c").over(inside.orderBy("bucket"))}
        if found is None:
            n = F.sum("c").over(inside)
            added |= {f"{name}_left": rank(n) for name, rank in wanted.items()}
            added |= {f"{name}_bucket": F.col("within") for name in wanted}
        running = counts.withColumns(added)
        found = running.agg(F.struct(*[_settle(name) for name in wanted]).alias("t"))
    return found.select(*[F.col(f"t.{name}.v").alias(name) for name in wanted])


def _settle(name: str) -> Column:
    """First bucket whose running total reaches the rank, and the rank left within it."""
    left = F.col(f"{name}_left")
    reached = (F.col("within") == F.col(f"{name}_bucket")) & (F.col("upto") >= left)
    inside = (left - F.col("upto") + F.col("c")).alias("left")
    return F.min(F.when(reached, F.struct("bucket", inside, "v"))).alias(name)
