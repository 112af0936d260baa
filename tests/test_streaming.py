from __future__ import annotations

import json
import os
from types import SimpleNamespace

import pytest

from patronlake.operators.events import clean_events
from patronlake.sources.landing import read_events
from patronlake.streaming import feed
from patronlake.streaming.scratch import scratch_folder


def event(event_id, stamp, kind="view_item"):
    return dict(
        event_id=event_id, timestamp=stamp, user_id="u", session_id="s", event_type=kind,
        product_id=None, device_os=None, time_spent_seconds=1,
    )


def drop_file(folder, order, *rows):
    folder.mkdir(exist_ok=True)
    path = folder / f"f{order}.json"
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    # File streams take the oldest file first.
    os.utime(path, (1_700_000_000 + order, 1_700_000_000 + order))


def run_days(spark, tmp_path, lateness="1 day"):
    events = feed.clean_event_stream(feed.event_stream(spark, str(tmp_path / "in"), 1))
    counts = feed.counts_by_day(feed.deduplicated(events, lateness), lateness)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    feed.write_day_counts(counts, out, checkpoint).awaitTermination()
    return {
        (str(r.day), r.event_type): r.cnt for r in feed.read_day_counts(spark, out).collect()
    }


def test_stream_cleaning_equals_batch_cleaning(spark, tmp_path):
    drop_file(tmp_path / "in", 1, event("1", "2024-01-01T10:00:00.000Z"),
              event("2", "2024-01-01T10:00:00.000Z", "purchase"))
    drop_file(tmp_path / "in", 2, event("3", "not a stamp"))
    stream = feed.clean_event_stream(feed.event_stream(spark, str(tmp_path / "in"), 1))
    feed.write_events(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = clean_events(read_events(spark, str(tmp_path / "in")))
    streamed = spark.read.schema(batch.schema).parquet(str(tmp_path / "out"))
    assert sorted(streamed.collect(), key=str) == sorted(batch.collect(), key=str)


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    drop_file(tmp_path / "in", 1, event("1", "2024-01-01T10:00:00.000Z"))

    def run():
        stream = feed.clean_event_stream(feed.event_stream(spark, str(tmp_path / "in")))
        feed.write_events(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == ["1"]
    assert run() == ["1"]
    drop_file(tmp_path / "in", 2, event("2", "2024-01-01T11:00:00.000Z"))
    assert run() == ["1", "2"]


def test_duplicates_and_late_events(spark, tmp_path):
    drop_file(tmp_path / "in", 1, event("1", "2024-01-01T10:00:00.000Z"),
              event("1", "2024-01-01T10:00:00.000Z"))
    drop_file(tmp_path / "in", 2, event("1", "2024-01-01T10:00:00.000Z"),
              event("2", "2024-01-05T10:00:00.000Z"))
    # A watermark takes effect one batch after the event that moved it.
    drop_file(tmp_path / "in", 3, event("5", "2024-01-05T11:00:00.000Z"))
    # Later than the watermark of 4 January.
    drop_file(tmp_path / "in", 4, event("3", "2024-01-01T12:00:00.000Z"))
    # Late, but within it.
    drop_file(tmp_path / "in", 5, event("4", "2024-01-04T23:00:00.000Z"))
    assert run_days(spark, tmp_path) == {
        ("2024-01-01", "view_item"): 1,
        ("2024-01-05", "view_item"): 2,
        ("2024-01-04", "view_item"): 1,
    }


def test_days_are_utc_days_in_any_session_zone(spark, tmp_path):
    drop_file(tmp_path / "in", 1, event("1", "2024-01-01T23:30:00.000Z"),
              event("2", "2024-01-02T00:30:00.000Z"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = run_days(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == {("2024-01-01", "view_item"): 1, ("2024-01-02", "view_item"): 1}


def test_incremental_pull_from_the_high_water_mark(spark, tmp_path):
    drop_file(tmp_path / "in", 1, *[event(str(i), f"2024-01-0{i}T00:00:00.000Z") for i in range(1, 6)])
    source = clean_events(read_events(spark, str(tmp_path / "in")))
    loaded = source.filter("event_id <= '3'")
    ids = sorted(r.event_id for r in feed.new_events(source, loaded).collect())
    assert ids == ["3", "4", "5"]
    assert feed.new_events(source, loaded.limit(0)).count() == 5
    source.write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    pulled = feed.new_events(stored, loaded)
    pulled.collect()
    plan = pulled._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan


def test_scratch_folder_is_shared_or_the_master_is_local():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="spark://host:7077")
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(cluster)


def test_scratch_folder_follows_the_cluster_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first != second
    if shared:
        assert first.startswith(shared.rstrip("/"))
