"""Nearest neighbours against all pairs, and the bounds of the tiles."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlake.llm import vector_join

SCHEMA = "vec_id long, embedding array<double>, query_row int, number int"


def plain(rows, k, step=20):
    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    rows = [(i, v) for i, v, *_ in rows if fine(v)]
    out = []
    for a, (query, q) in enumerate(rows):
        if query is None or query % step:
            continue
        scored = []
        for b, (own, c) in enumerate(rows):
            if a != b:
                total = 0.0
                for x, y in zip(q, c):
                    total += x * y
                scored.append((-total, own is None, own or 0))
        for rank, (score, none, own) in enumerate(sorted(scored)[:k], 1):
            out.append((query, rank, None if none else own, -score))
    return sorted(out, key=str)


def found(spark, rows, k, **options):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(3)
    got = vector_join.nearest(frame, F.col("vec_id") % 20 == 0, k=k, **options).collect()
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=str)


def vectors(seed, n, width=12):
    draw = random.Random(seed)
    common = [draw.gauss(0, 1) for _ in range(width)]
    rows = []
    for i in range(n):
        kind = draw.random()
        if kind < 0.3:
            v = common
        elif kind < 0.4:
            v = [float(draw.randint(-1, 1)) for _ in range(width)]
        elif kind < 0.5:
            v = [x + draw.gauss(0, 1e-6) for x in common]
        else:
            v = [draw.gauss(0, 1) for _ in range(width)]
        rows.append((i, v))
    return rows


@pytest.mark.parametrize("options", [
    {}, {"queries_per_group": 3, "candidates_per_column": 50}, {"queries_per_group": 1000, "candidates_per_column": 7},
])
def test_equals_all_pairs(spark, monkeypatch, options):
    monkeypatch.setattr(vector_join, "BLOCK_ROWS", 32)
    rows = vectors(1, 400)
    assert found(spark, rows, 20, **options) == plain(rows, 20)


def test_defined_cases(spark):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, None), (40, []), (60, [0.0, -0.0]), (80, [1.0, None]),
        (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]), (None, [1.0, 0.0]), (7, [2.0]), (3, [-0.0, 1.0]),
        (5, [0.0, 1.0]), (140, [0.5, 0.5, 9.0]), (2**63 - 1, [1.0, 0.0]), (-20, [1.0, 1.0]),
    ]
    assert found(spark, rows, 4) == plain(rows, 4)
    assert found(spark, rows, 50) == plain(rows, 50)


def test_empty_tables_and_few_candidates(spark):
    assert found(spark, [(0, [1.0])], 3) == []
    assert found(spark, [(1, [1.0])], 3) == []
    frame = spark.createDataFrame([], SCHEMA)
    assert vector_join.nearest(frame, F.col("vec_id") % 20 == 0).count() == 0


def test_very_long_and_very_large_vectors(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 1) for _ in range(3000 if i % 3 else 5)]) for i in range(60)]
    rows += [(100 + i, [draw.choice([1e200, 1e-200, -1e150]) for _ in range(3)]) for i in range(0, 40, 4)]
    rows += [(200, [5e-324, 0.0]), (220, [5e-324, 1.0])]
    ours, theirs = found(spark, rows, 10), plain(rows, 10)
    assert [(q, r) for q, r, *_ in ours] == [(q, r) for q, r, *_ in theirs]
    assert ours == theirs


def test_tiles_bound_their_errors_and_few_pairs_survive():
    draw = np.random.default_rng(3)

    def block(n):
        exact = draw.normal(size=(n, 64))
        exact /= np.linalg.norm(exact, axis=1, keepdims=True)
        return vector_join.Block({
            "numbers": np.arange(n).tobytes(), "ids": np.arange(n).tobytes(), "nameless": np.zeros(n, bool).tobytes(),
            "exact": exact.tobytes(), "n": n, "width": 64,
        })

    queries, candidates = block(40), block(2000)
    product, error = queries.tile(candidates, slice(0, 40))
    true = queries.exact @ candidates.exact.T
    assert (np.abs(product - true) <= error).all() and error.max() < 0.05
    heaps = vector_join.Heaps(40, 20)
    assert vector_join.meet(queries, candidates, heaps) < 40 * 60
    for i, heap in enumerate(heaps.heaps):
        assert {-order for _, order, _ in heap} == set(np.argsort(-true[i])[:20].tolist())
