"""Keyed tables and what is kept up to date by their changes, against whole recomputation."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline import quality as dq
from siltline.plans import gold
from siltline.plans.feeds import GOLD_SCHEMA, SILVER_SCHEMA
from siltline.quality.suite import CheckFailed
from siltline.sources.keyed_table import KeyedTable
from siltline.streaming.upkeep import Dimension, KeptMetric, maintain_fact, net_changes, sync

SCHEMA = "id BIGINT, at DATE, v INT"


def table_at(spark, path, slot="at", buckets=4):
    return KeyedTable(spark, str(path), SCHEMA, ["id"], slot, buckets)


def rows(spark, *lines):
    df = spark.createDataFrame(lines, "id BIGINT, at STRING, v INT, is_delete BOOLEAN")
    return df.withColumn("at", F.col("at").cast("date"))


def state(table):
    return {r.id: (str(r.at) if r.at else None, r.v) for r in table.read().collect()}


def test_random_batches(spark, tmp_path):
    """Every batch against a dictionary; rows move between days, go and come back."""
    draw, held = random.Random(7), {}
    table = table_at(spark, tmp_path / "t")
    for batch in range(4):
        lines = {}
        for _ in range(draw.randrange(1, 15)):
            key = draw.randrange(20)
            gone = draw.random() < 0.3
            lines[key] = (key, None if gone or draw.random() < 0.1 else f"2024-01-0{draw.randrange(1, 6)}", None if gone else batch * 100 + key, gone)
        table.merge(rows(spark, *lines.values()), {"w": batch})
        for key, at, v, gone in lines.values():
            held.pop(key, None) if gone else held.__setitem__(key, (at, v))
        assert state(table) == held
        assert table.marks() == {"w": batch}
    net = net_changes(table.changes(0), ["id"]).collect()
    assert {r.id: (str(r.after.at) if r.after.at else None, r.after.v) for r in net} == held
    found = {r.id: r for r in net_changes(table.changes(2), ["id"]).collect()}
    assert all(r.before != r.after for r in found.values())


def test_merge_reads_and_writes_only_its_buckets(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["id"], "at", 64)
    days = spark.range(20_000).select(
        "id", F.expr("date_add(DATE '2024-01-01', CAST(id % 3 AS INT))").alias("at"), F.lit(1).alias("v"))
    table.replace(days)
    assert len(table.partitions()) == 3 * 64
    before = {f: i for i, f in enumerate(table.located().inputFiles())}
    ends = rows(spark, (0, "2024-01-01", 5, False), (19_999, None, None, True))  # both ends of the domain
    buckets = {r[0] for r in ends.select(table.bucket_of()).distinct().collect()}
    near = table.located(buckets=buckets)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {f.split("_bucket=")[1].split("/")[0] for f in near.inputFiles()}
    table.merge(ends)
    after = set(table.located().inputFiles())
    rewritten = {f.split("data/")[1].rsplit("/", 1)[0] for f in before if f not in after}
    assert rewritten == {f"_slot=2024-01-0{1 + k % 3}/_bucket={b}" for k, b in
                         [(r.id, r.b) for r in ends.select("id", table.bucket_of().alias("b")).collect()]}
    assert len(read) >= len(buckets) and table.read().agg(F.count("*"), F.sum("v")).first() == (19_999, 19_999 + 4)
    pruned = table.between("at", "2024-01-02", "2024-01-02")
    assert "_slot" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert pruned.count() == 6666  # row 19,999 was one of them


def test_guarded_merge_keeps_newer_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA + ", is_delete BOOLEAN", ["id"], "at", 2)
    table.merge(rows(spark, (1, "2024-01-01", 5, False), (2, "2024-01-01", 5, True)), sequence=["v"])
    table.merge(rows(spark, (1, "2024-01-02", 4, False), (2, "2024-01-03", 9, False)), sequence=["v"])
    assert {r.id: (r.v, r.is_delete) for r in table.read().collect()} == {1: (5, False), 2: (9, False)}


def test_lost_driver_is_made_good(spark, tmp_path, monkeypatch):
    """Decided commits are published by the next writer, undecided ones are forgotten."""
    table = table_at(spark, tmp_path / "t")
    table.merge(rows(spark, (1, "2024-01-01", 1, False), (2, "2024-01-02", 2, False)))

    def lost(self):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", lost)
        with pytest.raises(RuntimeError):
            table.merge(rows(spark, (1, None, None, True), (3, "2024-01-03", 3, False)), {"w": 4})
    assert table.version() == 1
    again = table_at(spark, tmp_path / "t").create()
    assert again.version() == 2 and again.last_batch("w") == 4
    assert state(again) == {2: ("2024-01-02", 2), 3: ("2024-01-03", 3)}
    broken = rows(spark, (9, "2024-01-01", 9, False)).withColumn("v", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        table.merge(broken)
    with pytest.raises(CheckFailed):
        table.replace(rows(spark, (5, "2024-01-01", 1, False), (5, "2024-01-02", 1, False)).drop("is_delete"),
                      lambda df: dq.Suite(df, [dq.unique("id")]).enforce())
    assert state(table.create()) == {2: ("2024-01-02", 2), 3: ("2024-01-03", 3)}


def test_expired_and_replaced_changes_are_not_known(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    assert table.changes(-1) is None and table.changes(0).count() == 0
    for i in range(4):
        table.merge(rows(spark, (i, "2024-01-01", i, False)))
    assert table.changes(1).count() == 3 and table.changes(4).count() == 0
    assert table.expire(keep=2) == 2
    assert table.changes(1) is None and table.changes(2).count() == 2 and len(state(table)) == 4
    table.replace(rows(spark, (7, "2024-01-01", 7, False)).drop("is_delete"))
    assert table.changes(4) is None and state(table) == {7: ("2024-01-01", 7)}
    assert table.merge(rows(spark, (7, None, None, True)).where("false")) == 5


def test_sync_merges_what_differs(spark, tmp_path):
    table = table_at(spark, tmp_path / "t", slot=None)
    first = rows(spark, (1, "2024-01-01", 1, False), (2, None, None, False), (3, None, 3, False)).drop("is_delete")
    sync(table, first)
    assert sync(table, first) == 1
    sync(table, rows(spark, (1, "2024-01-01", 1, False), (2, None, 2, False), (4, None, 4, False)).drop("is_delete"))
    net = {r.id: (r.before and r.before.v, r.after and r.after.v) for r in net_changes(table.changes(1), ["id"]).collect()}
    assert net == {2: (None, 2), 3: (3, None), 4: (None, 4)}


TXN = "transaction_id BIGINT, customer_id INT, product_id INT, quantity INT, amount DECIMAL(10,2), " \
      "transaction_date STRING, status STRING, net_amount DECIMAL(10,2), is_delete BOOLEAN"


def transactions(spark, draw, n):
    lines = {}
    for _ in range(n):
        key, gone = draw.randrange(40), draw.random() < 0.25
        amount = None if draw.random() < 0.1 else Decimal(draw.randrange(1, 90))
        lines[key] = (key, draw.choice([1, 2, 3, None]), draw.randrange(3), draw.randrange(1, 5), amount,
                      f"2024-01-0{draw.randrange(1, 8)} 0{draw.randrange(10)}:00:00.000001", draw.choice(["NEW", "CANCELLED", "pending"]),
                      amount, gone)
    return spark.createDataFrame(list(lines.values()), TXN).withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))


def same(a, b):
    b = b.select(*[F.col(c).cast(t) for c, t in a.dtypes])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_metrics_by_signed_deltas(spark, tmp_path):
    """After every batch equal to the whole grouping, lost minima and maxima included."""
    draw = random.Random(3)
    source = KeyedTable(spark, str(tmp_path / "s"), SILVER_SCHEMA, ["transaction_id"], "transaction_date", 2)
    kept = {n: KeptMetric(source, str(tmp_path / n), m, c, 2) for n, m, c in (
        ("daily", gold.DAILY, gold.DAILY_COLUMNS), ("customer", gold.CUSTOMER, gold.CUSTOMER_COLUMNS),
        ("product", gold.PRODUCT, gold.PRODUCT_COLUMNS))}
    customers = spark.createDataFrame([(i, f"n{i}", "x", "y", "z") for i in range(3)],
                                      "customer_id INT, full_name STRING, country STRING, city STRING, customer_segment STRING")
    products = spark.createDataFrame([(i, f"p{i}", "x", "y", "z", 1.0) for i in range(3)],
                                     "product_id INT, product_name STRING, category STRING, brand STRING, color STRING, unit_price DOUBLE")
    for batch in range(3):
        source.merge(transactions(spark, draw, 25))
        if batch == 1:
            source.merge(transactions(spark, draw, 10))  # two commits are worked off at once
        for metric in kept.values():
            metric.refresh()
            assert metric.state.version() == batch + 1 and metric.refresh() == batch + 1
        now = source.read()
        same(kept["daily"].read(), gold.daily_summary(now))
        same(gold.with_customer(kept["customer"].read(), customers), gold.customer_metrics(now, customers))
        same(gold.with_product(kept["product"].read(), products), gold.product_performance(now, products))
    source.expire(keep=1)
    source.merge(transactions(spark, draw, 10))
    source.expire(keep=1)
    kept["customer"].refresh()  # changes are gone: computed from the whole table
    same(gold.with_customer(kept["customer"].read(), customers), gold.customer_metrics(source.read(), customers))


@pytest.mark.parametrize("propagate", [True, False])
def test_fact_by_changes_of_both_sides(spark, tmp_path, propagate):
    draw = random.Random(5)
    source = KeyedTable(spark, str(tmp_path / "s"), SILVER_SCHEMA, ["transaction_id"], "transaction_date", 2)
    wide = KeyedTable(spark, str(tmp_path / "g"), GOLD_SCHEMA, ["transaction_id"], "transaction_date", 2)

    def people(tag):
        return spark.createDataFrame([(i, f"n{i}{tag if i == 2 else ''}", "x", "y") for i in range(1, 4)],
                                     "customer_id INT, full_name STRING, country STRING, city STRING")

    def things(tag):
        return spark.createDataFrame([(i, f"p{i}{tag if i == 1 else ''}", "x", "y") for i in range(3)],
                                     "product_id INT, product_name STRING, category STRING, brand STRING")

    tables = []
    for name, rows_, key in (("c", people(""), "customer_id"), ("p", things(""), "product_id")):
        t = KeyedTable(spark, str(tmp_path / name), rows_.schema, [key], buckets=2)
        tables.append(t)
        sync(t, rows_)
    dimensions = [Dimension(t, t.keys[0], [c for c in t.names if c not in t.keys]) for t in tables]

    def build(rows_):
        return gold.fact_transactions(rows_, *[t.read() for t in tables])

    def upkeep():
        version = maintain_fact(source, wide, dimensions, build, propagate)
        full = build(source.read())
        if propagate:
            same(wide.read(), full)
        else:  # facts deleted upstream stay
            same(wide.read().join(source.read().select("transaction_id"), "transaction_id", "left_semi").select(full.columns), full)
        return version

    source.merge(transactions(spark, draw, 25))
    upkeep()
    source.merge(transactions(spark, draw, 15))
    sync(tables[0], people(" new"))  # both sides at once
    upkeep()
    assert upkeep() == 2  # nothing changed, nothing written
    slots = {r[0] for r in source.located().where("product_id = 1").select("_slot").distinct().collect()}
    before = set(wide.located().inputFiles())
    sync(tables[1], things(" new"))
    upkeep()
    rewritten = {f.split("_slot=")[1][:10] for f in before - set(wide.located().inputFiles())}
    assert rewritten <= slots and rewritten
    source.merge(transactions(spark, draw, 15))
    source.expire(keep=0)
    upkeep()


@pytest.mark.parametrize("small", [True, False])
def test_merges_with_many_changed_keys(spark, tmp_path, monkeypatch, small):
    """Where the changed keys are too many to broadcast, against a dictionary; commits are published
    by renaming what was written, without a further Spark job."""
    jobs, publish, context = [], KeyedTable._publish, spark.sparkContext

    def watched(self):
        context.setJobGroup("publish", "publish")
        publish(self)
        context.setJobGroup("other", "other")
        jobs.extend(context.statusTracker().getJobIdsForGroup("publish"))

    monkeypatch.setattr(KeyedTable, "_publish", watched)
    monkeypatch.setattr("siltline.sources.keyed_table.is_small", lambda *a: small)
    table = table_at(spark, tmp_path / "t")
    table.replace(rows(spark, *[(i, f"2024-01-0{1 + i % 3}", i, False) for i in range(20)], (None, "2024-01-01", 9, False)).drop("is_delete"))
    held = state(table)
    table.merge(rows(spark, (4, "2024-01-05", 40, False), (5, None, None, True), (6, None, 60, False), (30, "2024-01-01", 1, False), (31, None, None, True)))
    held |= {4: ("2024-01-05", 40), 6: (None, 60), 30: ("2024-01-01", 1)}
    del held[5]
    assert state(table) == held and table.read().count() == 21
    signed = sorted((r.id, r._sign, r.v) for r in table.changes(1).collect())
    assert signed == [(4, -1, 4), (4, 1, 40), (5, -1, 5), (6, -1, 6), (6, 1, 60), (30, 1, 1)]
    assert jobs == []


def test_fact_of_two_changed_dimensions_is_built_once(spark, tmp_path, monkeypatch):
    source = KeyedTable(spark, str(tmp_path / "s"), "id BIGINT, a INT, b INT", ["id"], buckets=2)
    wide = KeyedTable(spark, str(tmp_path / "g"), "id BIGINT, a INT, b INT", ["id"], buckets=2)
    sides = [Dimension(KeyedTable(spark, str(tmp_path / k), f"{k} INT, n STRING", [k], buckets=1), k, ["n"]) for k in "ab"]
    lines = [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, None, 1), (5, 2, 2), (6, 1, 1)]
    source.replace(spark.createDataFrame(lines, source.schema))
    for side in sides:
        sync(side.table, spark.createDataFrame([(1, "x"), (2, "y")], side.table.schema))
    built = []

    def build(df):
        built.append(sorted(r.id for r in df.collect()))
        return df

    maintain_fact(source, wide, sides, build)
    for side in sides:
        sync(side.table, spark.createDataFrame([(1, "other"), (2, "y")], side.table.schema))
    source.merge(spark.createDataFrame([(6, 1, 2, False)], "id BIGINT, a INT, b INT, is_delete BOOLEAN"))
    monkeypatch.setattr(DataFrame, "dropDuplicates", None)  # no shuffle of whole rows to find repeats
    maintain_fact(source, wide, sides, build)
    assert built == [[1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 6]]
    assert sorted((r.id, r.a, r.b) for r in wide.read().where("id = 6").collect()) == [(6, 1, 2)]


def metric_source(spark, path):
    draw = random.Random(11)
    source = KeyedTable(spark, str(path), SILVER_SCHEMA, ["transaction_id"], "transaction_date", 2)
    source.merge(transactions(spark, draw, 30))
    return source, draw


def test_sums_of_one_commit_need_no_net_changes(spark, tmp_path, monkeypatch):
    source, draw = metric_source(spark, tmp_path / "s")
    kept = KeptMetric(source, str(tmp_path / "p"), gold.PRODUCT, gold.PRODUCT_COLUMNS, 2)
    ends = KeptMetric(source, str(tmp_path / "c"), gold.CUSTOMER, gold.CUSTOMER_COLUMNS, 2)
    kept.refresh(), ends.refresh()
    monkeypatch.setattr("siltline.streaming.upkeep.net_rows", None)
    source.merge(transactions(spark, draw, 25))
    ends.refresh()
    source.merge(transactions(spark, draw, 25))
    kept.refresh()  # two commits
    now = source.read()
    want = now.groupBy("product_id").agg(F.sum("quantity"), F.count("*"), F.sum("net_amount"))
    same(kept.read(), want.toDF(*kept.read().columns))
    state_ = gold.CUSTOMER.state_schema(source.schema, spark)
    assert gold.CUSTOMER.adds_up(state_, 1) and not gold.CUSTOMER.adds_up(state_, 2)


def test_many_lost_ends_are_found_by_group(spark, tmp_path, monkeypatch):
    """The rows are added up by the tasks that read them, not first joined by a text of their group."""
    source, draw = metric_source(spark, tmp_path / "s")
    kept = KeptMetric(source, str(tmp_path / "c"), gold.CUSTOMER, gold.CUSTOMER_COLUMNS, 2)
    kept.refresh()
    source.merge(transactions(spark, draw, 25))
    firsts = source.read().groupBy("customer_id").agg(F.min("transaction_date").alias("transaction_date"))
    gone = source.read().join(firsts, ["customer_id", "transaction_date"]).select(source.names)
    source.merge(gone.withColumn("is_delete", F.lit(True)))
    monkeypatch.setattr("siltline.streaming.upkeep.is_small", lambda *a: False)
    monkeypatch.setattr("siltline.streaming.upkeep._key_of", None)
    kept.refresh()
    want = source.read().groupBy("customer_id").agg(
        F.min("transaction_date"), F.max("transaction_date"), F.count("*"), F.sum("net_amount"),
        F.round(F.try_divide(F.sum("net_amount"), F.count("*")), 2))
    same(kept.read(), want.toDF(*kept.read().columns))


def test_merge_writes_its_changes_once(spark, tmp_path, monkeypatch):
    """What a commit keeps of its changes is what they are merged from; few partitions need no shuffle."""
    plans, decide = [], KeyedTable._decide

    def watched(self, located, *args, **kwargs):
        plans.append(located._jdf.queryExecution().executedPlan().toString())
        return decide(self, located, *args, **kwargs)

    monkeypatch.setattr("siltline.sources.keyed_table.staged", None)
    table = table_at(spark, tmp_path / "t")
    table.replace(rows(spark, *[(i, f"2024-01-0{1 + i % 3}", i, False) for i in range(20)]).drop("is_delete"))
    monkeypatch.setattr(KeyedTable, "_decide", watched)
    table.merge(rows(spark, (4, "2024-01-05", 40, False), (5, None, None, True), (6, None, 60, None), (31, None, None, True)))
    assert "hashpartitioning" not in plans[0] and "REBALANCE" not in plans[0]
    assert sorted((r.id, r._sign, r.v) for r in table.changes(1).collect()) == [(4, -1, 4), (4, 1, 40), (5, -1, 5), (6, -1, 6)]
    assert state(table) == {i: (f"2024-01-0{1 + i % 3}", i) for i in range(20) if i not in (5, 6)} | {4: ("2024-01-05", 40)}
    monkeypatch.setattr("siltline.sources.keyed_table.FEW_PARTITIONS", 0)
    table.merge(rows(spark, (4, "2024-01-01", 41, False)))
    assert "hashpartitioning" in plans[1] and state(table)[4] == ("2024-01-01", 41)
    assert table.merge(rows(spark, (7, None, None, True)).where("false")) == 3
    assert table.changes(3).count() == 0
