import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline.llm import bitplanes

SCHEMA = "vec_id long, vector array<long>"


def expected(rows, k, rounds, seed=3):
    """Plain integers, one vector after the other."""
    rows = [r for r in rows if r[1] is not None]
    if not rows:
        return []
    named = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in named[:k]]

    def nearest(v):
        return min((sum((x - m) ** 2 for x, m in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in rows:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, members in groups.items():
            centroids[i] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *nearest(v)) for i, v in rows]
    inertia = {}
    for _, d, c in found:
        inertia[c] = inertia.get(c, 0) + d
    top = (1 << 63) - 1
    return sorted([(i, c, min(d, top), min(inertia[c], top), min(sum(inertia.values()), top),
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, d, c in found], key=str)


def got(frame, **options):
    return sorted((tuple(r) for r in bitplanes.clusters(frame, **options).collect()), key=str)


@pytest.mark.parametrize("low, high", [(-1024, 1024), (0, 1), (-3, -1), (-(1 << 26), 1 << 26), (-(1 << 61), 1 << 61)])
def test_products_are_exact(low, high):
    draw = np.random.default_rng(5)
    a, b = draw.integers(low, high, (20, 64), endpoint=True), draw.integers(low, high, (7, 64), endpoint=True)
    a[0], b[0] = low, high
    depth = bitplanes.depth_of(low, high)
    left, right = bitplanes.packed(a, depth), bitplanes.packed(b, depth)
    assert left.shape == (depth, 20)
    assert (bitplanes.products(left, right) == a.astype(object) @ b.astype(object).T).all()
    assert (bitplanes.squares(left) == (a.astype(object) ** 2).sum(1)).all()
    group = draw.integers(0, 3, 20)
    for g, n, sums in bitplanes.component_sums(left, group):
        assert n == (group == g).sum() and sums == a[group == g].astype(object).sum(0).tolist()


def test_against_plain_integers(spark):
    draw = random.Random(2)
    rows = [(i, [draw.randrange(-40, 40) + 60 * (i % 5) for _ in range(64)]) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(200, 260)]  # one vector many times
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for k, rounds in ((8, 10), (3, 2), (1, 1), (2, 0)):
        assert got(frame, k=k, rounds=rounds) == expected(rows, k, rounds)


def test_odd_rows(spark):
    flat = [1] * 64
    rows = [(1, flat), (1, [2] * 64), (2, flat), (2, flat), (None, [9] * 64), (3, None), (4, [-1] * 64)]
    frame = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA + ", cluster int")
    assert got(frame, k=3) == expected(rows, 3, 10)
    assert got(frame, k=50) == expected(rows, 50, 10)
    assert got(frame.limit(0)) == [] and got(frame.filter("vec_id = 3")) == []
    wide = [(i, [(-1) ** (i + j) * (1 << 61) for j in range(64)]) for i in range(6)]
    assert got(spark.createDataFrame(wide, SCHEMA), k=2) == expected(wide, 2, 10)


def test_integers(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[0.5] * 64, [-0.0001] * 64, [0.1] * 63, [0.1] * 65, [None] + [0.1] * 63, [nan] * 64, [inf] * 64, None, [],
               [1e300] * 64, [-1e300] * 64]
    frame = spark.createDataFrame([(v,) for v in vectors], "e array<double>")
    held = [r[0] for r in frame.select(bitplanes.integers(F.col("e"))).collect()]
    assert [h and h[0] for h in held] == [512, -1, None, None, None, None, None, None, None, bitplanes.REACH, -bitplanes.REACH]


def test_query_against_plain_integers(spark):
    from siltline.llm.workload import work

    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, [int(np.floor(1024 * float(x))) for x in r.embedding]) for r in table.collect()
            if r.embedding is not None and len(r.embedding) == 64 and all(x is not None and np.isfinite(x) for x in r.embedding)]
    out = work.queries["op13_centroid_clusters"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in out), key=str) == expected(rows, 8, 10)
