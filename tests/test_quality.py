from datetime import date, datetime

import pytest

from siltline import quality as dq
from siltline.quality.suite import CheckFailed


def failures(df, rule):
    """Number of failures, through the suite, for one rule."""
    return dq.Suite(df, [rule]).failures().first().failures


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_row_rules(spark):
    df = frame(spark, [(0.0, 1.0, "x"), (1.0, 0.0, " "), (0.5, 0.5, ""), (None, 0.5, None)],
               "a DOUBLE, b DOUBLE, s STRING")
    assert failures(df, dq.not_null("a")) == 1
    assert failures(df, dq.not_null("b")) == 0
    assert failures(df, dq.expression_is_true("a + b = 1")) == 0
    assert failures(df, dq.expression_is_true("= 0.5", "a", where="b = 0.5")) == 0
    assert failures(df, dq.expression_is_true("= 0.5", "a")) == 2
    assert failures(df, dq.not_empty_string("s")) == 2
    assert failures(df, dq.not_empty_string("s", trim=False)) == 1
    assert failures(df, dq.assert_equal("a", "b")) == 2
    assert failures(df, dq.assert_equal("a", "b", null_safe=True)) == 3
    assert dq.violations(df, dq.not_null("a")).count() == 1


def test_accepted_range(spark):
    df = frame(spark, [(-1,), (11,), (None,)], "id INT")
    assert failures(df, dq.accepted_range("id", -1, 11)) == 0
    assert failures(df, dq.accepted_range("id", -1, 11, inclusive=False)) == 2
    assert failures(df, dq.accepted_range("id", -2, 11.1, inclusive=False)) == 0
    assert failures(df, dq.accepted_range("id", 0, where="id <> -1")) == 0
    assert failures(df, dq.accepted_range("id", high="id - 1")) == 2
    assert failures(df, dq.accepted_range("id")) == 0


def test_values_and_keys(spark):
    df = frame(spark, [(1, "Barcelona"), (2, "London"), (2, "London"), (None, None), (None, None)],
               "id INT, city STRING")
    assert failures(df, dq.not_accepted_values("city", ["Madrid", "Berlin"])) == 0
    assert failures(df, dq.not_accepted_values("city", ["London"])) == 1
    assert failures(df, dq.accepted_values("city", ["London", "Barcelona"])) == 0
    assert failures(df, dq.accepted_values("city", ["Paris"])) == 2
    assert failures(df, dq.unique("id")) == 1
    assert failures(df, dq.unique_combination(["id", "city"])) == 2
    assert failures(df, dq.unique("concat(id, city)", name="expr")) == 1
    sales = frame(spark, [(date(2019, 1, 1), "tart", 500), (date(2019, 2, 1), "tart", 300)],
                  "month DATE, product STRING, revenue INT")
    assert failures(sales, dq.unique_combination(["month", "product"])) == 0


def test_at_least_one(spark):
    df = frame(spark, [("a", 1), ("b", None)], "field STRING, value INT")
    assert failures(df, dq.at_least_one("field")) == 0
    assert failures(df, dq.at_least_one("value")) == 0
    assert failures(df, dq.at_least_one("value", by=["field"])) == 1
    assert failures(df.limit(0), dq.at_least_one("value")) == 1
    assert failures(df.limit(0), dq.at_least_one("value", by=["field"])) == 0


def test_not_constant(spark):
    df = frame(spark, [(1, 1), (1, 1), (1, 2)], "a INT, field INT")
    assert failures(df, dq.not_constant("field")) == 0
    assert failures(df, dq.not_constant("field", by=["a"])) == 0
    assert failures(df, dq.not_constant("a")) == 1
    assert failures(frame(spark, [(None,)], "a INT"), dq.not_constant("a")) == 0


def test_not_null_proportion(spark):
    five = [1, None, None, 4, 5, 6, None, None, None, 10]
    nine = [1, 2, 3, 4, 5, 6, 7, 8, None, 10]
    df = frame(spark, list(zip(five, nine)), "point_5 INT, point_9 INT")
    assert failures(df, dq.not_null_proportion("point_5", 0.5, 0.5)) == 0
    assert failures(df, dq.not_null_proportion("point_9", 0.9)) == 0
    assert failures(df, dq.not_null_proportion("point_5", 0.9)) == 1
    assert failures(df, dq.not_null_proportion("point_9", 0.0, 0.8)) == 1
    assert failures(df, dq.not_null_proportion("point_5", 0, by=["point_9"])) == 0
    assert failures(df, dq.not_null_proportion("point_5", 0.5, by=["point_9"])) == 5


def test_recency(spark):
    df = frame(spark, [(1, datetime(2024, 1, 1, 0, 0)), (2, datetime(2024, 1, 1, 13, 0)), (3, None)],
               "id INT, at TIMESTAMP_NTZ")
    now = datetime(2024, 1, 2, 12, 0)
    assert failures(df, dq.recency("at", "day", 1, now)) == 0
    assert failures(df, dq.recency("at", "hour", 1, now)) == 1
    assert failures(df, dq.recency("at", "day", 1, now, by=["id"])) == 2
    assert failures(df, dq.recency("at", "day", 1, now, ignore_time=True, by=["id"])) == 1
    assert failures(df.limit(0), dq.recency("at", "day", 1, now)) == 1
    assert failures(df, dq.recency("at", "day", 1)) == 1


def test_row_counts(spark):
    a = frame(spark, [(1, 1), (1, 2), (2, 3)], "g INT, x INT")
    b = frame(spark, [(1, 1), (1, 2), (2, 3), (2, 4)], "g INT, x INT")
    other = frame(spark, [(3, 1), (None, 1)], "g INT, x INT")
    assert failures(a, dq.equal_rowcount(a, a)) == 0
    assert failures(a, dq.equal_rowcount(a, a, by=["g"])) == 0
    assert failures(a, dq.equal_rowcount(a, b)) == 1
    assert failures(a, dq.equal_rowcount(a, b, by=["g"])) == 1
    assert failures(a, dq.equal_rowcount(a, other, by=["g"])) == 5
    assert failures(a, dq.equal_rowcount(a, other, by=["g"], strict=False)) == 0
    assert failures(a, dq.equal_rowcount(a, a.limit(0))) == 3
    assert failures(a, dq.equal_rowcount(a, a.limit(0), strict=False)) == 0
    assert failures(a, dq.equal_rowcount(other, other, by=["g"])) == 0
    assert failures(a, dq.fewer_rows_than(a, b)) == 0
    assert failures(a, dq.fewer_rows_than(b, a)) == 1
    assert failures(a, dq.fewer_rows_than(a, a)) == 1
    assert failures(a, dq.fewer_rows_than(a, b, by=["g"])) == 1
    assert failures(a, dq.fewer_rows_than(a, other, by=["g"])) == 3
    assert failures(a, dq.fewer_rows_than(a, other, by=["g"], strict=False)) == 0


def test_cardinality_equality(spark, rows):
    a = frame(spark, [(1,), (2,), (3,)], "same_name INT")
    b = frame(spark, [(1, 2), (2, 3), (3, 1)], "same_name INT, different_name INT")
    assert failures(a, dq.cardinality_equality(a, "same_name", b, "different_name")) == 0
    c = frame(spark, [(1,), (1,), (2,), (4,), (None,)], "x INT")
    rule = dq.cardinality_equality(a, "same_name", c, "x")
    assert rows(rule.frame) == [(1, "model", 1), (1, "other", 2), (3, "model", 1), (4, "other", 1),
                                (None, "other", 1)]


def test_equality(spark):
    a = frame(spark, [(1, 1, 3), (1, 2, 1), (2, 3, 3)], "col_a INT, col_b INT, col_c INT")
    b = frame(spark, [(1, 1, 2), (1, 2, 2), (2, 3, 2)], "col_a INT, col_b INT, col_c INT")
    assert failures(a, dq.equality(a, a)) == 0
    assert failures(a, dq.equality(a, b)) == 6
    assert failures(a, dq.equality(a, b, columns=["col_a", "col_b"])) == 0
    assert failures(a, dq.equality(a, b, exclude=["COL_C"])) == 0
    assert failures(a, dq.equality(a, a.limit(0))) == 6  # 3 rows + difference of 3
    twice = a.unionAll(a)
    assert failures(a, dq.equality(a, twice)) == 0
    assert failures(a, dq.equality(a, twice, multiset=True)) == 6
    nulls = frame(spark, [(None, 1)], "x INT, y INT")
    assert failures(a, dq.equality(nulls, nulls)) == 0
    with pytest.raises(ValueError):
        dq.equality(a, b.drop("col_c"))
    with pytest.raises(ValueError):
        dq.equality(a, b, columns=["col_a"], exclude=["col_b"])


def test_equality_precision(spark):
    a = frame(spark, [("i", 62.3888186), ("j", 81.2511656)], "id STRING, f DOUBLE")
    b = frame(spark, [("i", 62.3888187), ("j", 81.2511657)], "id STRING, f DOUBLE")
    assert failures(a, dq.equality(a, b, precision=4)) == 0
    assert failures(a, dq.equality(a, b, precision=8)) == 4
    assert failures(a, dq.equality(a, b)) == 4


def test_relationships(spark, rows):
    one = frame(spark, [(1,), (2,), (3,), (None,)], "id INT")
    two = frame(spark, [(1,), (2,), (4,), (4,), (None,)], "id INT")
    assert failures(two, dq.relationships_where(two, "id", one, "id", "id <> 4")) == 0
    rule = dq.relationships_where(two, "id", one, "id", to_condition="id > 1")
    assert rows(rule.frame) == [(1, 1), (4, 2)]
    assert failures(two, rule) == 3


def test_sequential_values(spark, rows):
    df = frame(spark, [(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "a INT, v INT")
    assert failures(df, dq.sequential_values(df, "v", 2)) == 0
    assert failures(df, dq.sequential_values(df, "v", 2, by=["a"])) == 0
    assert failures(df, dq.sequential_values(df, "v", 1)) == 4
    gap = frame(spark, [(1,), (2,), (2,), (2,), (5,), (None,)], "v INT")
    rule = dq.sequential_values(gap, "v")
    assert rows(rule.frame) == [(2, 2, 2), (5, 2, 1)]
    assert failures(gap, rule) == 3
    hours = frame(spark, [(datetime(2021, 1, 1, h),) for h in range(4)], "at TIMESTAMP_NTZ")
    assert failures(hours, dq.sequential_values(hours, "at", 1, "hour")) == 0
    assert failures(hours, dq.sequential_values(hours, "at", 1, "day")) == 3
    assert failures(gap, dq.sequential_values(gap.limit(0), "v")) == 0


def test_ranges(spark):
    df = frame(spark, [(0, 1), (1, 2), (2, 4)], "a INT, b INT")
    assert failures(df, dq.mutually_exclusive_ranges(df, "a", "b", gaps="not_allowed")) == 0
    assert failures(df, dq.mutually_exclusive_ranges(df, "a", "b")) == 0
    assert failures(df, dq.mutually_exclusive_ranges(df, "a", "b", gaps="required")) == 2
    assert failures(df, dq.mutually_exclusive_ranges(df, "a", "b + 1")) == 2
    nulls = frame(spark, [(0, 1), (None, 2), (3, None)], "a INT, b INT")
    assert failures(nulls, dq.mutually_exclusive_ranges(nulls, "a", "b")) == 2
    twice = frame(spark, [(0, 1), (0, 1), (5, 6)], "a INT, b INT")
    assert failures(twice, dq.mutually_exclusive_ranges(twice, "a", "b")) == 1
    with pytest.raises(ValueError):
        dq.mutually_exclusive_ranges(df, "a", "b", gaps="some")


def test_ranges_by_group(spark):
    df = frame(spark, [
        (1, date(2019, 1, 1), date(2019, 2, 1)), (1, date(2019, 3, 3), date(2019, 4, 1)),
        (2, date(2019, 5, 6), date(2019, 7, 2)), (2, date(2019, 7, 3), None),
    ], "id INT, a DATE, b DATE")
    upper = "coalesce(b, DATE '2099-12-31')"
    for gaps in ("allowed", "required"):
        assert failures(df, dq.mutually_exclusive_ranges(df, "a", upper, ["id"], gaps)) == 0
    assert failures(df, dq.mutually_exclusive_ranges(df, "a", upper, ["id"], "not_allowed")) == 2
    zero = frame(spark, [(3, 6, 7), (3, 8, 10), (3, 8, 8), (3, 12, 15), (4, 6, 7), (4, 8, 8),
                         (4, 9, 10)], "id INT, a INT, b INT")
    assert failures(zero, dq.mutually_exclusive_ranges(zero, "a", "b", ["id"], zero_length=True)) == 0
    assert failures(zero, dq.mutually_exclusive_ranges(zero, "a", "b", ["id"])) == 2


def test_columns_match(spark):
    df = spark.createDataFrame([(1, 2)], "Id INT, extra INT")
    assert dq.columns_match(df, ["ID", "missing"]) == [("extra", "unexpected"), ("missing", "missing")]
    assert dq.columns_match(df, ["id", "EXTRA"]) == []


def test_suite_thresholds_and_storage(spark, tmp_path):
    df = frame(spark, [(1, "a"), (1, None), (None, None)], "id INT, s STRING")
    suite = dq.Suite(df, [
        dq.not_null("id"),
        dq.not_null("s", warn_if="> 1", error_if="> 5"),
        dq.unique("id", warn_if="> 3", error_if="> 3"),
        dq.unique("id", name="must_fail", error_if="< 1", warn_if="< 0"),
        dq.at_least_one("s", by=["id"], name="s_per_id"),
        dq.not_constant("id", where="id IS NOT NULL"),
        dq.equal_rowcount(df, df),
    ])
    report = {r.rule: (r.failures, r.status) for r in suite.report().collect()}
    assert report == {
        "not_null_id": (1, "error"), "not_null_s": (2, "warn"), "unique_id": (1, "pass"),
        "must_fail": (1, "pass"), "s_per_id": (1, "error"), "not_constant_id": (1, "error"),
        "equal_rowcount": (0, "pass"),
    }
    with pytest.raises(CheckFailed, match="not_null_id: 1"):
        suite.enforce()
    stored = suite.store_failures(str(tmp_path / "failures"))
    assert spark.read.parquet(stored["not_null_s"]).count() == 2
    with pytest.raises(ValueError):
        dq.Suite(df, [dq.not_null("id"), dq.not_null("id")])


def test_suite_fuses_rules(spark):
    """Rules without keys add no scan, rules with the same keys share one."""
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    suite = dq.Suite(df, [
        dq.not_null("l_orderkey"), dq.not_null("l_partkey"), dq.accepted_range("l_tax", 0, 1),
        dq.not_constant("l_tax"), dq.at_least_one("l_tax"),
        dq.unique("l_orderkey"), dq.not_accepted_values("l_orderkey", [1]),
    ])
    plan = suite.failures()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_where_limits_the_rows_before_a_frame_is_made(spark):
    df = frame(spark, [(1, "x", 0), (3, "x", 1), (4, "y", 1)], "value INT, lang STRING, side INT")
    other = frame(spark, [(3, "x", 1), (4, "y", 1)], "value INT, lang STRING, side INT")
    assert failures(df, dq.sequential_values(df, "value", where="value > 1")) == 0
    assert failures(df, dq.sequential_values(df, "value", where="lang = 'x'")) == 1
    assert failures(df, dq.equal_rowcount(df, other, where="side = 1")) == 0
    assert failures(df, dq.equal_rowcount(df, other)) == 1
    assert failures(df, dq.fewer_rows_than(df, other, where="lang = 'y'")) == 0
    assert failures(df, dq.fewer_rows_than(df, other)) == 1
    assert failures(df, dq.cardinality_equality(df, "value", other, "value", where="side = 1")) == 0
    assert failures(df, dq.cardinality_equality(df, "value", other, "value")) == 1
    assert failures(df, dq.equality(df, other, where="side = 1")) == 0
    assert failures(df, dq.equality(df, other, ["value"], where="lang = 'y'")) == 2  # 3 is missing now
    assert failures(df, dq.relationships_where(df, "value", other, "value", where="side = 1")) == 0
    assert failures(df, dq.relationships_where(df, "value", other, "value")) == 1
    ranges = dq.mutually_exclusive_ranges(df, "value", "value + 2", where="lang = 'x'")
    assert failures(df, ranges) == 0
    assert failures(df, dq.mutually_exclusive_ranges(df, "value", "value + 2")) == 1
    with pytest.raises(ValueError):
        dq.equality(df, other).with_options(where="side = 1")
