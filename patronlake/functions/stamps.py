"""Time stamps as UTC wall clock (``timestamp_ntz``), independent of the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NTZ = "timestamp_ntz"
_ZONED = r"(Z|z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?)$"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(NTZ)


def utc_wall_clock(instant: Column) -> Column:
    """``timestamp`` → ``timestamp_ntz`` in UTC, exact in every session zone."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    zero = F.lit(0)
    return _epoch() + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def instant_of(wall_clock: Column) -> Column:
    """``timestamp_ntz`` in UTC → ``timestamp``; needed where Spark insists on an instant."""
    seconds = (wall_clock - _epoch()).cast("interval second").cast("decimal(18,6)")
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))


def parse_stamp(column: Column, kind: T.DataType) -> Column:
    """Default parse. A stamp that cannot be read gives NULL instead of failing the job.

    Text with a zone is moved to UTC; text without one is taken as it stands.
    """
    if isinstance(kind, T.TimestampNTZType):
        return column
    if isinstance(kind, T.TimestampType):
        return utc_wall_clock(column)
    if isinstance(kind, T.DateType):
        return column.cast(NTZ)
    text = F.trim(column.cast("string"))
    has_zone = text.rlike(r"\d{1,2}:\d{2}.*" + _ZONED)
    return F.when(has_zone, utc_wall_clock(text.try_cast("timestamp"))).otherwise(text.try_cast(NTZ))


def parse_event_stamp(column: Column, kind: T.DataType, fmt: str) -> Column:
    """ISO-8601 with milliseconds and zone; typed stamps pass as they are."""
    if isinstance(kind, T.StringType):
        return utc_wall_clock(F.try_to_timestamp(column, F.lit(fmt)))
    return parse_stamp(column, kind)


def whole_seconds(column: Column) -> Column:
    """Drop the fraction, as a seconds-resolution DateTime column does at load."""
    return F.left(column.cast("string"), F.lit(19)).cast(NTZ)


# Shapes accepted by shift_text, in order of trial: full stamp, ISO with fraction and Z, ISO
# without, date only.
_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"\d{1,2}:\d{1,2}:\d{1,2}"
STAMP_SHAPES = [
    rf"^{_DATE}\s{_TIME}$",
    rf"^{_DATE}T{_TIME}\.\d{{1,6}}Z$",
    rf"^{_DATE}T{_TIME}$",
    rf"^{_DATE}$",
]
# Fixed value: the last day of the historical data, which the shift moves onto the anchor.
HISTORY_END = dt.datetime(2018, 10, 17)


def shift_text(column: Column, anchor: dt.datetime) -> Column:
    """Move a text stamp by (anchor − end of history), keeping its shape.

    Blank and unreadable values stay as they are.
    """
    delta = anchor - HISTORY_END
    text = F.trim(column)
    wall = F.regexp_replace(text, "Z$", "").try_cast(NTZ)
    step = F.make_dt_interval(
        F.lit(delta.days), F.lit(0), F.lit(0),
        F.lit(delta.seconds + delta.microseconds / 1e6).cast("decimal(18,6)"),
    )
    moved = (wall + step).cast("string")
    to_second = F.left(moved, F.lit(19))
    fraction = F.rpad(F.substring(moved, 21, 6), 6, "0")
    spaced, fractional, plain, day = (text.rlike(shape) for shape in STAMP_SHAPES)
    iso = F.regexp_replace(to_second, " ", "T")
    return F.coalesce(
        F.when(spaced, to_second)
        .when(fractional, F.concat(iso, F.lit("."), fraction, F.lit("Z")))
        .when(plain, iso)
        .when(day, F.left(moved, F.lit(10))),
        column,
    )
