"""Order-sensitive checks against brute force, for many random cases as groups of one frame."""

import random
from collections import Counter

import pytest

from siltline import quality as dq
from siltline.operators import neighbours

CASES = 150


@pytest.fixture(params=["sliced", "window"])
def path(request, monkeypatch):
    """Both plans: sliced by ranges, and a window per counted group."""
    monkeypatch.setattr(neighbours.groups_are_small, "__defaults__",
                        (0 if request.param == "sliced" else 10**9,))
    monkeypatch.setattr(neighbours, "SLICE_BYTES", 600)  # a few rows
    return request.param


def ranges(seed):
    rng = random.Random(seed)

    def bound():
        return None if rng.random() < 0.07 else rng.randrange(12)

    return [(case, bound(), bound()) for case in range(CASES) for _ in range(rng.randrange(0, 6))]


def range_failures(rows, gaps, zero_length):
    """Failing rows of one group, by walking its rows in order."""
    def order(row):
        return (row[0] is None, row[0] or 0, row[1] is None, row[1] or 0)

    line, failing = sorted(rows, key=order), 0
    for i, (low, high) in enumerate(line):
        following = line[i + 1][0] if i + 1 < len(line) else None
        both = low is not None and high is not None
        proper = both and (low <= high if zero_length else low < high)
        if following is None:
            meets = True  # last bounded row; an unbounded one fails by itself
        else:
            meets = high is not None and {
                "not_allowed": high == following, "allowed": high <= following,
                "required": high < following}[gaps]
        failing += not (proper and meets)
    return failing


@pytest.mark.parametrize("gaps, zero_length", [
    ("allowed", False), ("not_allowed", True), ("required", True)])
def test_ranges(spark, path, gaps, zero_length):
    rows = ranges(len(gaps))
    df = spark.createDataFrame(rows, "g INT, a INT, b INT").repartition(5)
    rule = dq.mutually_exclusive_ranges(df, "a", "b", ["g"], gaps, zero_length)
    got = {r.g: r.n for r in rule.frame.groupBy("g").agg({"n_rows": "sum"}).toDF("g", "n").collect()}
    want = {}
    for case in range(CASES):
        n = range_failures([(a, b) for g, a, b in rows if g == case], gaps, zero_length)
        if n:
            want[case] = n
    assert got == want


def test_sequences(spark, path):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(CASES)]), rng.choice([None, *range(9)]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g INT, v INT, i INT").repartition(5)
    frame = dq.sequential_values(df, "v", 1, by=["g"]).frame
    got = Counter()
    for r in frame.collect():
        got[(r.g, r.value, r.previous)] += r.n_rows
    want = Counter()
    for group in {g for g, _, _ in rows}:
        line = sorted(v for g, v, _ in rows if g == group and v is not None)
        for before, value in zip(line, line[1:]):
            if value != before + 1:
                want[(group, value, before)] += 1
    assert got == want


@pytest.mark.parametrize("buckets", [None, 1, 5, 1000])
@pytest.mark.parametrize("multiset", [False, True])
def test_equality(spark, multiset, buckets):
    rng = random.Random(4)

    def side():
        return [(rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for _ in range(14)]

    a, b = side(), side()
    schema = "k INT, s STRING"
    rule = dq.equality(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema),
                       multiset=multiset, buckets=buckets)
    ca, cb = Counter(a), Counter(b)
    want = {
        (("a_minus_b" if ca[r] > cb[r] else "b_minus_a"), *r) for r in ca | cb
        if (ca[r] != cb[r] if multiset else bool(ca[r]) != bool(cb[r]))
    }
    assert {tuple(r) for r in rule.frame.collect()} == want
