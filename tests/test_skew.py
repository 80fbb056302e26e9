"""Operators under heavy keys, against brute force in plain Python."""

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from siltline.operators import joins
from siltline.operators.latest import latest_per_key
from siltline.operators.neighbours import with_neighbour
from siltline.plans import gold
from siltline.workloads import layers


def skewed(n, seed):
    """A third of the rows in group 0, some in the NULL group, repeats throughout."""
    rng = random.Random(seed)
    return [
        (0 if rng.random() < 0.34 else rng.choice([None, 1, 2, 3, 50]), rng.randrange(n // 2), i)
        for i in range(n)
    ]


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("n, parts", [(1000, 7), (40, 16)])
def test_neighbour_across_slices(spark, n, parts, following):
    data = sorted({(g, v) for g, v, _ in skewed(n, n)}, key=str)
    df = spark.createDataFrame(data, "g INT, v INT").repartition(3)
    aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        size = 32 * len(data)  # two columns a row
        out = with_neighbour(df, ["g"], ["v"], "v", "near", following, slice_bytes=size // parts)
        assert "_edge" in out._jdf.queryExecution().optimizedPlan().toString()
        got = {(r.g, r.v): r.near for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)
    want = {}
    for g in {g for g, _ in data}:
        line = sorted(v for h, v in data if h == g)
        ends = [*line[1:], None] if following else [None, *line[:-1]]
        want |= {(g, v): e for v, e in zip(line, ends)}
    assert got == want
    assert len(want) == len(data)


def test_neighbour_ungrouped(spark):
    df = spark.createDataFrame([(v,) for v in range(0, 999, 3)], "v INT").repartition(5)
    for slice_bytes in (None, 1000, 16):  # one slice, some, one for each row
        out = with_neighbour(df, [], ["v"], "v", "previous", slice_bytes=slice_bytes)
        assert ("_edge" in out._jdf.queryExecution().optimizedPlan().toString()) == (slice_bytes is not None)
        assert out.where("v <> previous + 3").count() == 0
        assert out.where("previous IS NULL").count() == 1
    none = with_neighbour(df.limit(0), [], ["v"], "v", "previous", slice_bytes=1)
    assert none.count() == 0


def test_lookup_salts_heavy_keys(spark, rows):
    facts = spark.createDataFrame(skewed(600, 5), "k INT, v INT, id INT")
    names = spark.createDataFrame([(k, f"n{k}") for k in (0, 1, 2, 50)], "k INT, name STRING")
    assert set(joins.heavy_keys(facts, "k", 0.3)) == {0}
    assert None in joins.heavy_keys(facts, "k", 0.05)
    small = joins.lookup(facts, names, "k")
    salted = joins.lookup(facts, names, "k", max_rows=1, salts=8)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert salted.columns == small.columns
    assert rows(salted) == rows(small)
    assert salted.count() == 600


def test_lookup_without_heavy_keys(spark, rows):
    facts = spark.createDataFrame([(i, i) for i in range(500)], "k INT, v INT")
    names = spark.createDataFrame([(i, str(i)) for i in range(0, 500, 2)], "k INT, name STRING")
    assert joins.heavy_keys(facts, "k") == []
    assert rows(joins.lookup(facts, names, "k", max_rows=1)) == rows(joins.lookup(facts, names, "k"))


def test_is_small(spark):
    assert joins.is_small(spark.range(10), 10)
    assert not joins.is_small(spark.range(11), 10)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"), F.array("id").alias("a"))
    assert joins.is_small(wide, 10, 20_000) and not joins.is_small(wide, 10, 10_000)
    assert joins.is_small(wide.limit(0), 10)


def test_latest_limits_rows_before_the_shuffle(spark, rows):
    data = skewed(900, 9)
    df = spark.createDataFrame(data, "g INT, v INT, id INT")
    out = latest_per_key(df, ["g"], ["v", "id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    want = {}
    for g, v, i in data:
        want[g] = max(want.get(g, (-1, -1)), (v, i))
    assert rows(out) == sorted(
        ((g, *v) for g, v in want.items()), key=lambda r: [(x is None, str(x)) for x in r]
    )


def test_latest_puts_nulls_last(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "c")], "k INT, o INT, x STRING")
    assert rows(latest_per_key(df, ["k"], ["o"])) == [(1, 5, "b"), (2, None, "c")]
    assert rows(latest_per_key(df, ["k"], [F.asc_nulls_first("o")]))[0] == (1, None, "a")


def counted(spark, df):
    """The frame, and a count of the rows that are computed of it."""
    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v

    first = df.columns[0]
    kind = df.schema[first].dataType
    return df.withColumn(first, F.udf(count, kind).asNondeterministic()(first)), seen


def test_heavy_keys_in_one_pass(spark):
    """Its rows are computed once, and tasks ship no keys."""
    df, seen = counted(spark, spark.createDataFrame(skewed(600, 5), "k INT, v INT, id INT"))
    assert set(joins.heavy_keys(df, "k", 0.3)) == {0}
    assert seen.value == 600
    assert joins.heavy_keys(df.limit(0), "k") == []
    many = spark.range(200_000).select(
        F.when(F.col("id") % 50 == 0, 7).when(F.col("id") % 60 == 1, None).otherwise(F.col("id") + 100).alias("k"))
    assert set(joins.heavy_keys(many, "k")) == {7, None}
    assert joins.heavy_keys(many.select(F.col("k").cast("string").cast("binary").alias("k")), "k", 0.015) != []


def test_fact_computes_its_transactions_once(spark, rows, monkeypatch):
    """Also where the dimensions are too large to broadcast and heavy keys are looked for."""
    lines = spark.createDataFrame(
        [(i, 5 if i % 2 else i, i % 7 or None, 1, "1.5", "NEW") for i in range(300)],
        "transaction_id BIGINT, customer_id INT, product_id INT, quantity INT, amount STRING, status STRING",
    ).withColumns({"amount": F.col("amount").cast("decimal(10,2)"), "net_amount": F.lit(1).cast("decimal(10,2)"),
                   "transaction_date": F.lit("2024-01-01").cast("timestamp")})
    transactions, seen = counted(spark, lines)
    customers = spark.createDataFrame([(i, f"n{i}", "x", "y") for i in range(0, 300, 3)],
                                      "customer_id INT, full_name STRING, country STRING, city STRING")
    products = spark.createDataFrame([(i, f"p{i}", "x", "y") for i in range(1, 5)],
                                     "product_id INT, product_name STRING, category STRING, brand STRING")
    for name, frame in (("transactions", transactions), ("customers", customers), ("products", products)):
        monkeypatch.setattr(layers, f"silver_{name}", lambda spark, folder, frame=frame: frame)
    small = rows(gold.fact_transactions(lines, customers, products))
    monkeypatch.setattr(gold, "lookup", partial(joins.lookup, max_rows=1))
    assert rows(layers.fact(spark, "none")) == small
    assert seen.value == 300
