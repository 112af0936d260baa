"""Structured Streaming jobs over the append-only event feed.

Outputs are keyed by micro-batch, so a batch replayed after a failure overwrites its own output and
nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from patronlake import schemas as S
from patronlake.functions.stamps import instant_of, utc_wall_clock
from patronlake.operators.events import clean_events

DAY_COUNTS = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("cnt", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines drops as they arrive."""
    reader = spark.readStream.schema(S.CLICKSTREAM_JSON)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def clean_event_stream(raw: DataFrame) -> DataFrame:
    """The batch cleaning, unchanged: it keeps no state."""
    return clean_events(raw)


def with_event_time(events: DataFrame, lateness: str) -> DataFrame:
    """Watermarks need an instant; clean stamps are UTC wall clock. A stream has one watermark, so
    a column that is there already is kept."""
    if "event_time" in events.columns:
        return events
    return events.withColumn("event_time", instant_of(F.col("timestamp"))).withWatermark(
        "event_time", lateness
    )


def deduplicated(events: DataFrame, lateness: str) -> DataFrame:
    """Drop re-posted events. Ids are remembered for ``lateness`` only, so state stays bounded."""
    return with_event_time(events, lateness).dropDuplicatesWithinWatermark(["event_id"])


def counts_by_day(events: DataFrame, lateness: str) -> DataFrame:
    """Events per UTC day and type; a day's state goes once the watermark has passed it."""
    day = F.window("event_time", "1 day")
    return (
        with_event_time(events, lateness)
        .groupBy(day.alias("w"), "event_type")
        .agg(F.count("*").alias("cnt"))
        .select(F.to_date(utc_wall_clock(F.col("w.start"))).alias("day"), "event_type", "cnt")
    )


def write_events(events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        events.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_day_counts(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Update mode: each micro-batch writes the days it changed under its own batch id."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )


def read_day_counts(spark: SparkSession, out: str) -> DataFrame:
    """Last written count per day and type."""
    written = spark.read.schema(DAY_COUNTS).parquet(out)
    return written.groupBy("day", "event_type").agg(F.max_by("cnt", "batch_id").alias("cnt"))


def high_water_mark(target: DataFrame) -> DataFrame:
    """One row: the newest stamp already loaded; the earliest of all stamps while there is none."""
    earliest = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return target.agg(F.coalesce(F.max("timestamp"), earliest).alias("since"))


def new_events(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source events from the high-water mark on; all of them while the target is empty.

    The mark itself is included, as events of the same stamp may arrive later; merge by event_id.
    Events whose stamp could not be read have no place in time: they come with a full load only. The
    plain comparison reaches the Parquet scan.
    """
    return source.filter(F.col("timestamp") >= high_water_mark(target).scalar())
