import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline.llm import knn

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, is_query, k):
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [int(np.floor(64 * x)) for x in v]
        kept[i] = min(kept.get(i, v), v)
    out = []
    for q in filter(is_query, kept):
        scored = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, k=20, **more):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x"))
    vectors = frame.select("vec_id", "rank", knn.integral(F.col("embedding")).alias("vector"))
    return sorted(map(tuple, knn.top_k(vectors, F.col("vec_id") % 20 == 0, k, **more).collect()))


@pytest.mark.parametrize("shape", ["spread", "clusters", "equal"])
def test_against_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(knn, "GROUP_QUERIES", 3)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 4, (5, 6))
    points = {"spread": rng.normal(0, 1, (200, 6)), "clusters": centres[rng.integers(0, 5, 200)] + rng.normal(0, .1, (200, 6)),
              "equal": np.repeat(rng.normal(0, 1, (2, 6)), 100, axis=0)}[shape]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    assert found(spark, rows, 7, pivots=9) == plain(rows, lambda i: i % 20 == 0, 7)


def test_bounds_leave_most_pairs_out(spark, monkeypatch):
    """On clustered vectors of one length fewer than a fifth of all pairs are compared, the result is whole."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (24, 16))
    points = centres[rng.integers(0, 24, 1500)] + rng.normal(0, .01, (1500, 16))
    points *= 8 / np.linalg.norm(points, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    plans = []
    assert found(spark, rows, 7, report=plans.append) == plain(rows, lambda i: i % 20 == 0, 7)
    plan, = plans
    assert plan.all_pairs == 75 * 1500 and plan.compared < plan.all_pairs / 5
    assert len(plan.groups) > 1 and sum(plan.asked) == 75
    monkeypatch.setattr(knn, "BROADCAST_NEEDS", 0)  # the plan as a table that shuffles
    assert found(spark, rows[:400], 3, pivots=10) == plain(rows[:400], lambda i: i % 20 == 0, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [3.0]),
            (None, [9.0, 9.0]), (6, []), (7, [1e12, -1e12]), (-20, [0.5, 0.5]), (8, [1.0, 2.0]), (9, [1.0, 2.0])]
    assert found(spark, rows) == plain(rows, lambda i: i % 20 == 0, 20)
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0])]) == []
    assert found(spark, [(0, [1.0])]) == []
