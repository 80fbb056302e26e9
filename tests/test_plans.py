"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from siltline import quality as dq
from siltline.quality.tables import _in_differing_buckets
from siltline.operators import shape
from siltline.operators.changes import merge_changes, parse_events
from siltline.plans import gold
from siltline.sources.files import read_table
from siltline.workloads import tables

FOLDER = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def items(spark):
    return read_table(spark, FOLDER, "lineitem")


def test_unpivot_scans_once(items):
    out = plan(shape.unpivot(items.select("l_orderkey", "l_tax", "l_discount"), ["l_orderkey"]))
    assert out.count("FileScan") == 1 and "Exchange" not in out


def test_pivot_scans_once_and_reads_its_columns(items):
    out = plan(shape.pivot(items, ["l_suppkey"], "l_returnflag", ["A", "N", "R"]))
    assert out.count("FileScan") == 1 and out.count("Exchange") == 1
    assert "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string>" in out


def test_equality_scans_each_side_once(items):
    a = items.select("l_orderkey", "l_linenumber")
    out = plan(dq.equality(a, a.where("l_linenumber < 3")).frame)
    assert out.count("FileScan") == 2 and out.count("Exchange") == 1 and "Join" not in out


def test_equality_by_buckets_shuffles_differing_rows_only(items):
    """Of equal tables a row per bucket, whatever their order; of others the rows that may differ."""
    a = items.select("l_orderkey", "l_linenumber", "l_quantity")
    turned = a.orderBy(F.rand(1))

    def shuffled(b):
        """Rows that pass the semi join and go to the grouping."""
        frame = dq.equality(a, b, buckets=256).frame
        frame.collect()
        plan_text = frame._jdf.queryExecution().executedPlan().toString()
        assert plan_text.count("BroadcastHashJoin") >= 1 and "SortMergeJoin" not in plan_text
        return frame.count()

    assert shuffled(turned) == 0
    changed = a.withColumn("l_quantity", F.when((F.col("l_orderkey") == 7) & (F.col("l_linenumber") == 1), F.lit(-1.0)).otherwise(F.col("l_quantity")))
    assert shuffled(changed) == 2
    both = a.withColumns({"_a": F.lit(1), "_b": F.lit(0)}).union(changed.withColumns({"_a": F.lit(0), "_b": F.lit(1)}))
    left = _in_differing_buckets(both, a.columns, 256).count()
    assert 2 <= left < both.count() / 50


def test_filters_and_columns_reach_the_scan(items):
    rule = dq.accepted_range("l_quantity", 1, 50, where="l_returnflag = 'R'")
    out = plan(dq.violations(items, rule).select("l_orderkey"))
    assert "EqualTo(l_returnflag,R)" in out and "l_comment" not in out
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in out


def test_row_counts_need_no_join(items):
    out = plan(dq.equal_rowcount(items, items, by=["l_suppkey"]).frame)
    assert "Join" not in out and out.count("Exchange") == 1


def test_events_are_parsed_once(spark):
    events = spark.createDataFrame([("{}",)], "value STRING")
    out = plan(parse_events(events, tables.USER_FEED.row).select("before.user_id", "op"))
    assert out.count("from_json") == 1


def test_merge_is_one_join(spark):
    target = read_table(spark, FOLDER, "orders").select("o_orderkey", "o_custkey")
    changes = target.withColumn("is_delete", F.lit(False))
    out = plan(merge_changes(target, changes, ["o_orderkey"]))
    assert out.count("LeftAnti") == 1


def test_metrics_group_before_they_join(spark):
    txn = tables.silver_transactions(spark, FOLDER)
    out = plan(gold.customer_metrics(txn, tables.silver_customers(spark, FOLDER)))
    join = out.index("Join [customer_id")
    assert out.index("HashAggregate(keys=[customer_id") > join  # the grouping lies below the join


def test_no_query_uses_a_cross_join(spark):
    import __spark_entry__ as entry
    for name in ("gold_fact_transactions", "dq_equal_rowcount", "dq_suite_fused",
                 "shape_attach_scalar", "dq_sequential_values_global", "col_haversine"):
        out = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in out and "NestedLoop" not in out, name


def test_at_least_one_stops_early(items):
    out = plan(dq.violations(items, dq.at_least_one("l_tax")))
    assert "Limit 1" in out or "limit=1" in out
