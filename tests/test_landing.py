from __future__ import annotations

import pytest

from patronlake.operators.cleaning import rejected_values
from patronlake.operators.events import clean_events, events_plan
from patronlake.operators.tickets import clean_tickets
from patronlake.sources import landing


def test_jdbc_ranges_of_pages_meet_every_row_once():
    clauses = landing.jdbc_predicates(10, 4)
    assert clauses == [
        "ctid < '(2,0)'::tid", "ctid >= '(2,0)'::tid AND ctid < '(5,0)'::tid",
        "ctid >= '(5,0)'::tid AND ctid < '(7,0)'::tid", "ctid >= '(7,0)'::tid",
    ]
    assert landing.jdbc_predicates(0, 4) == ["TRUE"] and len(landing.jdbc_predicates(2, 4)) == 2
    with pytest.raises(ValueError):
        landing.jdbc_predicates(10, 0)


def test_jdbc_properties_stream_rows_and_keep_stamps_without_zone():
    properties = landing.jdbc_properties("me", "secret", fetch_rows=500)
    assert properties["fetchsize"] == "500" and properties["driver"] == "org.postgresql.Driver"
    assert properties["preferTimestampNTZ"] == "true"


def test_landing_counts_while_writing(spark, tmp_path):
    assert landing.land(spark.range(1234), f"{tmp_path}/t") == 1234
    assert landing.land(spark.range(5), f"{tmp_path}/t") == 5
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5


def test_json_events_with_broken_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"event_id":"1","timestamp":"2024-01-01T00:00:00.001Z","session_id":"s",'
        '"event_type":"view_item"}\nnot json\n'
    )
    (tmp_path / "b.json").write_text(
        '{"event_id":"2","timestamp":"2024-01-01T00:00:00.002Z","session_id":"s",'
        '"event_type":"add_to_cart","time_spent_seconds":7}\n'
    )
    (tmp_path / "c.json").write_text(
        '{"event_id":"3","timestamp":"2024-01-01T00:00:00.002Z","event_type":"add_to_cart",'
        '"time_spent_seconds":99999999999}\n{"event_id":"4","timestamp":"now","event_type":"add_to_cart",'
        '"time_spent_seconds":"abc"}\n'
    )
    raw = landing.read_events(spark, str(tmp_path))
    lines = landing.corrupt_lines(raw).collect()
    assert [(r.raw_value, r.reason) for r in lines] == [("not json", "unreadable line")]
    clean = {r.event_id: r.time_spent_seconds for r in clean_events(raw).collect()}
    assert clean == {"1": None, "2": 7, "3": None, "4": None}
    rejected = rejected_values(raw, events_plan(raw)).collect()
    assert sorted((r.row_key, r.column_name, r.raw_value) for r in rejected) == [
        ("3", "time_spent_seconds", "99999999999"), ("4", "time_spent_seconds", "abc"), ("4", "timestamp", "now"),
    ]


HEADER = "Ticket_ID,Order_ID,Customer_Email,Issue_Type,Status,Customer_Rating,Reported_Date\n"


def test_all_ticket_drops_are_read(spark, tmp_path):
    (tmp_path / "CS_Tickets.csv").write_text(
        HEADER + 't1,o1,a@b.co,Product Issue,Open,1.0,2024-01-01 10:00:00\n'
    )
    (tmp_path / "CS_Tickets_20240102.csv").write_text(
        HEADER + 't2,,"x ""y"", z",,,5,2024-01-02\n'
    )
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    rows = clean_tickets(landing.read_tickets(spark, str(tmp_path))).orderBy("ticket_id").collect()
    assert [(r.ticket_id, r.order_id, r.issue_category, r.status, r.rating) for r in rows] == [
        ("t1", "o1", "Product Issue", "Open", 1), ("t2", None, "Positive Feedback", "Unknown", 5),
    ]


def test_ticket_drop_without_issue_type(spark, tmp_path):
    (tmp_path / "CS_Tickets.csv").write_text(
        HEADER.replace("Issue_Type,", "") + "t1,o1,,Open,3,2024-01-01\n"
    )
    raw = landing.read_tickets(spark, str(tmp_path), with_issue_type=False)
    assert clean_tickets(raw).first().issue_category == "General Inquiry"


def test_event_batches_append_to_their_day(spark, tmp_path):
    path = f"{tmp_path}/feed"
    batch = spark.createDataFrame([("1",), ("2",)], "event_id string")
    assert landing.append_events(batch, path, "2024-01-01") == 2
    assert landing.append_events(batch.limit(0), path, "2024-01-01") == 0
    assert landing.append_events(batch.limit(1), path, "2024-01-02") == 1
    days = spark.read.json(path).groupBy("ingest_date").count().collect()
    assert {str(r.ingest_date): r["count"] for r in days} == {"2024-01-01": 2, "2024-01-02": 1}
