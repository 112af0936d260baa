"""Calendar periods of the serving queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRANULARITIES = ("day", "month", "year")


def period_start(column: Column, granularity: str) -> Column:
    if granularity == "day":
        return F.to_date(column)
    if granularity == "month":
        return F.trunc(column, "MM")
    if granularity == "year":
        return F.trunc(column, "YEAR")
    raise ValueError(f"granularity must be one of {GRANULARITIES}, not {granularity!r}")


def period_label(column: Column, granularity: str) -> Column:
    """Axis label: yyyy-MM for months, yyyy for years, the whole date for days."""
    text = column.cast("string")
    return {"day": text, "month": F.left(text, F.lit(7)), "year": F.left(text, F.lit(4))}[granularity]


def yyyymm(column: Column) -> Column:
    return (F.year(column) * 100 + F.month(column)).cast("int")


def month_bounds(month: str | dt.date) -> tuple[dt.date, dt.date]:
    """First day of the month and of the next one, from a date, 'yyyy-MM' or 'yyyy-MM-dd'."""
    if isinstance(month, str):
        month = dt.date.fromisoformat(month if len(month) > 7 else f"{month}-01")
    first = month.replace(day=1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    return first, following


def in_month(df: DataFrame, stamp: str, month: str | dt.date | None) -> DataFrame:
    """Optional month filter. ``None`` keeps everything.

    Written as a half-open range, which reaches the Parquet scan; ``trunc(ts) = month`` would not.
    A ``yyyymm`` partition column, where the table has one, is used to prune directories as well.
    """
    if month is None:
        return df
    first, following = month_bounds(month)
    bound = [F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz") for d in (first, following)]
    df = df.filter((F.col(stamp) >= bound[0]) & (F.col(stamp) < bound[1]))
    if "yyyymm" in df.columns:
        df = df.filter(F.col("yyyymm") == first.year * 100 + first.month)
    return df
