from __future__ import annotations

import random

from patronlake.llm.components import components
from patronlake.llm.shared import Workspace


def test_components_of_chains_stars_and_repeats(spark):
    draw = random.Random(1)
    big = 1 << 62
    edges = [(i, i + 1) for i in range(0, 60)]
    edges += [(100, i) for i in range(101, 160)] + [(7, 7), (-5, big), (big, -5), (big, big - 1)]
    draw.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(df, Workspace(spark, "test")).collect()}
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {-5: -5, big: -5, big - 1: -5}
    assert found == expected


def test_no_edges_give_no_rows(spark):
    empty = spark.createDataFrame([], "a long, b long")
    assert components(empty, Workspace(spark, "test")).count() == 0
