import pytest
from pyspark.sql import functions as F

from siltline.functions import numeric, text, urls


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_surrogate_key_golden_hashes(spark):
    df = spark.createDataFrame(
        [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)],
        "x STRING, y STRING, z STRING",
    ).coalesce(1)
    assert values(df, text.surrogate_key("x"), text.surrogate_key("x", "y", "z")) == [
        ("0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]
    legacy = text.surrogate_key("x", "y", nulls_as_empty=True)
    assert values(df.limit(2), legacy)[1] == values(spark.range(1), F.md5(F.lit("a-")))[0]


def test_safe_arithmetic(spark):
    schema = "a INT, b INT, c INT"
    add = spark.createDataFrame(
        [(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], schema).coalesce(1)
    assert values(add, numeric.safe_add("a", "b", "c")) == [(6,), (4,), (2,), (0,)]
    sub = spark.createDataFrame(
        [(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], schema).coalesce(1)
    assert values(sub, numeric.safe_subtract("a", "b", "c")) == [(0,), (1,), (-2,), (0,)]
    div = spark.createDataFrame(
        [(6, 0), (10, 5), (None, 9), (0, 5), (4, None)], "a INT, b INT").coalesce(1)
    assert values(div, numeric.safe_divide("a", "b")) == [(None,), (2.0,), (None,), (0.0,), (None,)]
    assert values(div.limit(2), numeric.safe_divide("a * 2", "b * 1"))[1] == (4.0,)
    with pytest.raises(ValueError):
        numeric.safe_add()


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0,
               700000.0, 0.0]
    df = spark.createDataFrame([(a,) for a in amounts], "amount DOUBLE").coalesce(1)
    bucket = numeric.width_bucket("amount", "200000.0", "600000.0", 4)
    assert [v for v, in values(df, bucket)] == [0, 1, 2, 2, 3, 3, 4, 5, 5, 0]


def test_haversine(spark):
    df = spark.createDataFrame(
        [(48.864716, 2.349014, 52.379189, 4.899431)], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    assert values(df, F.round(numeric.haversine("a", "b", "c", "d"), 0),
                  F.round(numeric.haversine("a", "b", "c", "d", unit="km"), 0)) == [(267.0, 430.0)]
    with pytest.raises(ValueError):
        numeric.haversine("a", "b", "c", "d", unit="nm")


CASES = [("", ""), ("!Hell0 world-hi", "hell0_world_hi"), ("0Hell0 world-hi", "_0hell0_world_hi"),
         (None, "")]


def test_slug(spark):
    df = spark.createDataFrame([(i,) for i, _ in CASES], "t STRING").coalesce(1)
    assert [v for v, in values(df, text.slug("t"))] == [o for _, o in CASES]
    assert [text.slug_name(i) for i, _ in CASES] == [o for _, o in CASES]


def test_url_host(spark):
    cases = {
        "www.example.co.uk?utm_source=google&utm_medium=cpc": "www.example.co.uk",
        "http://running.example.com/2018/01/tips/": "running.example.com",
        "https://news.example.com/2018/01/01/blog": "news.example.com",
        "android-app://m.example.com/": "m.example.com",
        "docs.example.com/2021/01/01/index.js?utm_source=google": "docs.example.com",
        "https://example.com:8080/x": "example.com:8080",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u STRING").coalesce(1)
    assert [v for v, in values(df, urls.url_host("u"))] == list(cases.values())


def test_url_path(spark):
    cases = {
        "www.example.co.uk?utm_source=google": None,
        "http://running.example.com/2018/01/tips/?a=b": "2018/01/tips/",
        "https://news.example.com/2018/01/01/blog": "2018/01/01/blog",
        "http://plain.example.com": None,
        "android-app://m.example.com/": "",
        "https://a.b/c#top": "c#top",
        "a.b?next=/c": None,
        "https://arch.org/w/https://e.com/a": "w/https://e.com/a",
        None: None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u STRING").coalesce(1)
    assert [v for v, in values(df, urls.url_path("u"))] == list(cases.values())


def test_url_parameter(spark):
    df = spark.createDataFrame([
        ("http://shop.example.com/tea?utm_medium=organic",),
        ("http://shop.example.com/tea?utm_medium=organic&utm_source=github#x",),
        ("http://a.b/?href=1&ref=",),
    ], "u STRING").coalesce(1)
    assert values(df, urls.url_parameter("u", "utm_medium"), urls.url_parameter("u", "utm_source"),
                  urls.url_parameter("u", "ref")) == [
        ("organic", None, None), ("organic", "github", None), (None, None, None)]
