"""fact_events_log, and reads of the raw event feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions.stamps import parse_event_stamp
from patronlake.operators.cleaning import CleanPlan, clean_rows

# Bounds and default of the feed's page size.
PAGE_LIMITS = (1, 10_000)
DEFAULT_PAGE = 1_000


def events_plan(raw: DataFrame) -> CleanPlan:
    kind = raw.schema["timestamp"].dataType
    return CleanPlan(
        S.FACT_EVENTS_LOG.name,
        "event_id",
        {
            "event_id": F.col("event_id"),
            "timestamp": parse_event_stamp(F.col("timestamp"), kind, S.EVENT_STAMP_FORMAT),
            "user_id": F.col("user_id"),
            "session_id": F.col("session_id"),
            "event_type": F.col("event_type"),
            "product_id": F.col("product_id"),
            "device_os": F.col("device_os"),
            "time_spent_seconds": F.col("time_spent_seconds").try_cast("int"),
        },
        parsed={"timestamp": "timestamp", "time_spent_seconds": "time_spent_seconds"},
        keep=F.col("event_type").isin(*S.EVENT_TYPES),
    )


def clean_events(raw: DataFrame) -> DataFrame:
    """Works on a batch and on a stream alike. Unknown and NULL event types drop out."""
    return clean_rows(raw, events_plan(raw))


def _since(column: str, raw: DataFrame, since: str | dt.datetime) -> Column:
    """Text stamps compare as text, as the feed does; typed stamps as stamps."""
    value = since if isinstance(since, str) else since.isoformat(sep=" ")
    return F.col(column) >= F.lit(value).cast(raw.schema[column].dataType)


def events_since(raw: DataFrame, since: str | dt.datetime | None) -> DataFrame:
    return raw if since is None else raw.filter(_since("timestamp", raw, since))


def events_page(
    raw: DataFrame,
    limit: int = DEFAULT_PAGE,
    offset: int = 0,
    since: str | dt.datetime | None = None,
) -> DataFrame:
    """One page of the feed, ordered by (timestamp, event_id), with its total and has_more.

    Top-k per partition, then a merge of at most offset + limit rows. For a walk through the whole
    feed use ``events_after``, whose cost does not grow with the position.
    """
    low, high = PAGE_LIMITS
    if not low <= limit <= high or offset < 0:
        raise ValueError(f"limit must be within {PAGE_LIMITS} and offset not negative")
    matching = events_since(raw, since)
    total = matching.agg(F.count("*").alias("n"))
    return (
        matching.orderBy("timestamp", "event_id")
        .offset(offset)
        .limit(limit)
        .withColumn("total", total.scalar())
        .withColumn("has_more", F.lit(offset + limit) < F.col("total"))
    )


def events_after(
    raw: DataFrame, position: tuple[dt.datetime | str, str] | None, limit: int = DEFAULT_PAGE
) -> DataFrame:
    """The page that follows the row at ``position`` = (timestamp, event_id)."""
    if position is not None:
        stamp, event_id = position
        at = _since("timestamp", raw, stamp)
        later = F.col("timestamp") > F.lit(str(stamp)).cast(raw.schema["timestamp"].dataType)
        raw = raw.filter(at & (later | (F.col("event_id") > event_id)))
    return raw.orderBy("timestamp", "event_id").limit(limit)


def event_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count("*").alias("total_events"))


def latest_events(events: DataFrame, keep: int = 100) -> DataFrame:
    return events.orderBy(F.desc_nulls_last("timestamp"), F.desc("event_id")).limit(keep)


def latest_type_counts(events: DataFrame, keep: int = 100) -> DataFrame:
    return latest_events(events, keep).groupBy("event_type").agg(F.count("*").alias("cnt"))


def session_funnel(events: DataFrame) -> DataFrame:
    """Sessions that view, then also add to cart, then also abandon; and the step conversions."""
    reached = [
        F.max(F.when(F.col("event_type") == step, 1).otherwise(0)).alias(step)
        for step in S.EVENT_TYPES
    ]
    viewed, carted, abandoned = (F.col(step) == 1 for step in S.EVENT_TYPES)
    counts = (
        events.groupBy("session_id")
        .agg(*reached)
        .agg(
            F.count("*").alias("sessions"),
            F.count_if(viewed).alias("viewed"),
            F.count_if(viewed & carted).alias("carted"),
            F.count_if(viewed & carted & abandoned).alias("abandoned"),
        )
    )
    return counts.withColumns({
        "view_to_cart": F.try_divide(F.col("carted").cast("double"), "viewed"),
        "cart_to_abandon": F.try_divide(F.col("abandoned").cast("double"), "carted"),
    })
