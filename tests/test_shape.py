from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from siltline.operators import shape
from siltline.operators.latest import latest_per_key
from siltline.operators.series import date_spine, intervals_between, series


@pytest.fixture
def fields(spark):
    return spark.createDataFrame([("a", "b", "c"), ("d", "e", "f"), ("g", "h", "i")],
                                 "field_1 STRING, field_2 STRING, field_3 STRING")


def test_star(fields):
    assert fields.select(*shape.star(fields, ["FIELD_3"])).columns == ["field_1", "field_2"]
    assert fields.select(*shape.star(
        fields, ["field_3"], prefix="prefix_", suffix="_suffix", rename={"Field_2": "two"}
    )).columns == ["prefix_field_1_suffix", "two"]
    assert shape.star(fields, fields.columns) == []
    assert shape.other_columns(fields, ["Field_1"]) == ["field_2", "field_3"]
    top = fields.agg(*[F.max(c).alias(c) for c in shape.other_columns(fields, ["field_1"])])
    assert top.first() == ("h", "i")


def test_star_with_aggregate(spark, rows):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)],
                               "g1 STRING, g2 STRING, v INT")
    assert rows(shape.group_first(df, 2, F.sum("v"))) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]
    with pytest.raises(ValueError):
        shape.group_first(df, 4)


def test_nulls_for_empty(spark, rows):
    df = spark.createDataFrame([("", "x", 1), (None, "", 2)], "a STRING, b STRING, c INT")
    assert rows(shape.nulls_for_empty(df)) == [(None, "x", 1), (None, None, 2)]


@pytest.fixture
def two(spark):
    one = spark.createDataFrame([(1, "dan", "pi"), (2, "bob", "e"), (3, "alice", "4")],
                                "id INT, name STRING, favorite_number STRING")
    other = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)],
                                  "ID INT, favorite_color STRING, favorite_number INT")
    return {"one": one, "two": other}


def test_union(two, rows):
    out = shape.union_tables(two)
    assert out.columns == ["source_table", "id", "name", "favorite_number", "favorite_color"]
    assert rows(out) == [
        ("one", 1, "dan", "pi", None), ("one", 2, "bob", "e", None), ("one", 3, "alice", "4", None),
        ("two", 1, None, "7", "green"), ("two", 2, None, "13", "pink")]
    # The type is text whichever table comes first.
    turned = shape.union_tables({"two": two["two"], "one": two["one"]}, source_column=None)
    assert dict(turned.dtypes)["favorite_number"] == "string"


def test_union_options(two, rows):
    assert shape.union_tables(two, exclude=["NAME"]).columns == [
        "source_table", "id", "favorite_number", "favorite_color"]
    assert shape.union_tables(two, include=["Id", "name"], source_column=None).columns == ["id", "name"]
    assert rows(shape.union_tables(two, include=["id"], where="id = 1")) == [("one", 1), ("two", 1)]
    typed = shape.union_tables(two, include=["id"], types={"ID": "double"}, source_column=None)
    assert typed.dtypes == [("id", "double")]
    with pytest.raises(ValueError):
        shape.union_tables(two, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        shape.union_tables(two, include=["nothing"])


@pytest.fixture
def sizes(spark):
    return spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")],
                                 "size STRING, color STRING")


def test_pivot(sizes, rows):
    out = shape.pivot(sizes, ["size"], "color", ["red", "blue", "blue's"])
    assert out.columns == ["size", "red", "blue", "blue's"]
    assert rows(out) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    slugs = shape.pivot(sizes, ["size"], "color", ["red", "blue's"], slug_names=True, suffix=" n")
    assert slugs.columns == ["size", "red_n", "blues_n"]
    distinct = shape.pivot(sizes, [], "color", ["x"], agg="count", cmp="!=", then_value="size",
                           else_value=None, distinct=True)
    assert rows(distinct) == [(2,)]


def test_unpivot(spark, rows):
    df = spark.createDataFrame([
        (123, date(2017, 1, 1), "active", "tier 1", True, "name 1"),
        (567, date(2017, 3, 1), "churned", None, None, "name 2"),
    ], "Customer_Id INT, created_at DATE, sTaTuS STRING, segment STRING, is_updated BOOLEAN, name STRING")
    out = shape.unpivot(df, ["customer_id", "created_at"], ["NAME"], field_name="prop", value_name="val")
    assert out.columns == ["Customer_Id", "created_at", "prop", "val"]
    assert rows(out.drop("created_at")) == [
        (123, "is_updated", "true"), (123, "sTaTuS", "active"), (123, "segment", "tier 1"),
        (567, "is_updated", None), (567, "sTaTuS", "churned"), (567, "segment", None)]
    assert shape.unpivot(df.select("Customer_Id", "name")).columns == ["field_name", "value"]


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1), (3, None, None)],
                               "user_id INT, event STRING, version INT")
    assert rows(latest_per_key(df, ["user_id"], ["version"])) == [
        (1, "play", 2), (2, "pause", 1), (3, None, None)]


def test_column_values(spark):
    df = spark.createDataFrame(
        [(v, "left" if v in "aceg" else "right") for v in "abcdefggggg"], "field STRING, side STRING")
    assert shape.value_list(df, "field")[0] == "g"
    assert shape.value_list(df, "field", order_by=["field"]) == list("abcdefg")
    assert shape.value_list(df, "field", order_by=["field desc"], limit=2) == ["g", "f"]
    assert shape.value_list(df, "field", where="side = 'left'", order_by=["field"]) == list("aceg")
    assert shape.value_list(df, "field", where="side = 'up'", default=["z"]) == ["z"]


def test_pivot_over_many_values(spark):
    df = spark.range(1200).selectExpr("id % 3 AS k", "id AS v")
    values = shape.value_list(df, "v", order_by=["v"])
    assert values == list(range(1200))
    wide = shape.pivot(df, ["k"], "v", values, agg="count", else_value=None)
    assert len(wide.columns) == 1201 and wide.where("k = 0").first()["`3`".strip("`")] == 1


def test_scalars(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "a INT")
    out = shape.attach_scalar(df, df.agg(F.max("a")), "top")
    assert rows(shape.attach_scalar(out, df.where("a > 5"), "none", 0)) == [(1, 2, 0), (2, 2, 0)]
    assert shape.single_value(df.where("a = 2")) == 2
    assert shape.single_value(df.where("a = 3"), "default") == "default"


def test_series(spark, rows):
    assert rows(series(spark, 9)) == [(i,) for i in range(1, 10)]
    with pytest.raises(ValueError):
        series(spark, 0)


def test_date_spine(spark, rows):
    days = date_spine(spark, "day", date(2018, 1, 1), date(2018, 1, 10))
    assert rows(days) == [(datetime(2018, 1, d),) for d in range(1, 10)]
    assert date_spine(spark, "day", date(2018, 1, 1), date(2018, 1, 1)).count() == 0
    assert date_spine(spark, "hour", datetime(2018, 1, 1), datetime(2018, 1, 2)).count() == 24
    assert intervals_between(spark, date(2024, 1, 31), date(2024, 2, 29), "month") == 0
    assert intervals_between(spark, date(2024, 1, 1), date(2025, 1, 1), "quarter") == 4
    with pytest.raises(ValueError):
        date_spine(spark, "fortnight", date(2018, 1, 1), date(2018, 1, 2))


def test_union_keeps_wider_values(spark, rows):
    tables = {
        "a": spark.sql("SELECT 1 AS n, 1 AS m, DATE '2020-01-01' AS d"),
        "b": spark.sql("SELECT 1.75D AS n, 5000000000 AS m, TIMESTAMP_NTZ '2020-01-02 03:04:05' AS d"),
    }
    for order in (["a", "b"], ["b", "a"]):
        out = shape.union_tables({k: tables[k] for k in order}, source_column=None)
        assert sorted(r.n for r in out.collect()) == [1.0, 1.75]
        assert sorted(r.m for r in out.collect()) == [1, 5000000000]
        assert max(r.d for r in out.collect()).hour == 3
