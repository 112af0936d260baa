"""Ordered funnels against a walk through each session."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.operators import funnel


def walked(rows):
    """(session, time, id, type) rows: steps taken by each session."""
    reached = {}
    for session, _, _, kind in sorted(rows, key=lambda r: (r[0] or "", r[1] is None, r[1] or 0, r[2])):
        state = reached.setdefault(session, 0)
        if state < 3 and kind == S.EVENT_TYPES[state]:
            reached[session] = state + 1
    return reached


def drawn(n, seed=3):
    draw = random.Random(seed)
    kinds = [*S.EVENT_TYPES, "other", None]
    rows = []
    for i in range(n):
        # one session holds a third of the events, some events have no session, stamps collide
        session = draw.choice(["hot", f"s{draw.randrange(n // 8 + 1)}", f"s{draw.randrange(n // 8 + 1)}", None])
        rows.append((session, draw.choice([None, draw.randrange(50)]), f"e{i:05}", draw.choice(kinds)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "session_id string, timestamp int, event_id string, event_type string").repartition(7)


def test_progress_equals_a_walk(spark):
    rows = drawn(3000)
    found = funnel.session_progress(frame(spark, rows)).collect()
    assert {r.session_id: r.reached for r in found} == walked(rows) and len(found) == len(walked(rows))


def test_a_session_over_many_tasks_and_batches(spark):
    late = [("hot", i, f"e{i:05}", "add_to_cart") for i in range(900)]
    rows = [*late, ("hot", 900, "v", "view_item"), ("hot", 901, "x", "cart_abandonment"), ("a", 1, "v", "view_item")]
    assert walked(rows) == {"hot": 1, "a": 1}
    rows += [("hot", 2000, "c", "add_to_cart"), ("hot", 2000, "b", "cart_abandonment"), ("hot", 2001, "d", "cart_abandonment")]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {r.session_id: r.reached for r in funnel.session_progress(frame(spark, rows)).collect()}
        spread = frame(spark, rows).repartitionByRange("session_id", "timestamp").filter("session_id = 'hot'")
        assert spread.select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert found == walked(rows) == {"hot": 3, "a": 1}


def test_moves_compose():
    draw = np.random.default_rng(5)
    codes = draw.integers(-1, 3, 200)
    whole = funnel.moves(codes, np.array([0]), np.array([200]), 3)[0]
    for cut in (0, 1, 77, 199, 200):
        first, second = funnel.moves(codes, np.array([0, cut]), np.array([cut, 200]), 3)
        assert (second[first] == whole).all()


def test_empty(spark):
    row = funnel.ordered_funnel(frame(spark, drawn(20)).limit(0)).first()
    assert row.sessions == 0 and row.viewed == 0 and row.view_to_cart is None
