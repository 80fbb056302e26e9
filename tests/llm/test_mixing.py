import pytest
from pyspark.sql import functions as F

from siltline.llm import mixing
from siltline.llm.workload import weights_in_turn

SCHEMA = "doc_id long, text string, source string"


def fill(sizes, weights, epochs, share=1.0):
    """Clamp and reshare until none is above."""
    total, stopped = sum(sizes) * share, set()
    while True:
        left = total - sum(epochs * sizes[i] for i in stopped)
        rest = sum(w for i, w in enumerate(weights) if i not in stopped)
        goal = [epochs * s if i in stopped else (left * weights[i] / rest if rest else 0.0)
                for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if i not in stopped and goal[i] > epochs * s}
        if not above:
            return goal
        stopped |= above


@pytest.mark.parametrize("sizes,weights,epochs,share", [
    ([100, 10, 1000, 5], [5, 2, 1, 5], 3, 1.0), ([7, 7, 7], [1, 1, 1], 3, 1.0), ([10, 0, 90], [9, 9, 1], 2, 1.0),
    ([10, 20], [1, 0], 3, 1.0), ([4, 4], [0, 0], 3, 1.0), ([10, 20, 30], [5, 2, 1], 3, 4.0), ([0, 0], [1, 2], 3, 1.0),
])
def test_targets(spark, sizes, weights, epochs, share):
    frame = spark.createDataFrame([(f"s{i}", s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights))],
                                  "source string, source_size long, weight double")
    found = [r.target for r in mixing.targets(frame, epochs, share).orderBy("source").collect()]
    assert found == pytest.approx(fill(sizes, weights, epochs, share))


def test_mix_is_near_target_and_repeats(spark):
    docs = [(i, "w " * (i % 50 + 1), "big" if i % 3 else f"s{i % 4}") for i in range(3000)]
    frame = spark.createDataFrame(docs, SCHEMA)
    found = mixing.mix(frame, weights_in_turn).collect()
    assert len(found) == 3000
    by = {}
    for r in found:
        assert r["size"] <= 50 and r.taken <= 3 * r["size"]
        t = by.setdefault(r.source, [r.target, 0])
        t[1] += r.taken
    for target, taken in by.values():
        assert abs(target - taken) <= 25
    again = mixing.mix(frame.repartition(7), weights_in_turn).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    other = mixing.mix(frame, weights_in_turn, seed=1).collect()
    assert sorted(map(tuple, found)) != sorted(map(tuple, other))


def test_odd_rows(spark):
    docs = [(1, None, None), (None, "a b", None), (2, "", "x"), (2, "a", "x"), (2, "a", "x"), (3, "  a", "x")]
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("size", F.lit("s")).withColumn("target", F.lit(1))
    found = mixing.mix(frame, weights_in_turn).collect()
    assert sorted(r["size"] for r in found) == [0, 0, 1, 1, 2, 2]
    assert {r.source: r.source_size for r in found} == {None: 2, "x": 4}
    assert mixing.mix(spark.createDataFrame([], SCHEMA), weights_in_turn).count() == 0
