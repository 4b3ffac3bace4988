from __future__ import annotations

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shoptrail.functions import keys, numbers, params, text
from shoptrail.plans import staging
from tests.feeds import cs_frame, ga4, ga4_frame, param

URLS = {
    "https://a.b/p/1?x=1#top": ("/p/1", "a.b", "x=1#top"),
    "https://a.b": (None, "a.b", None),
    "https://a.b/p?": ("/p", "a.b", ""),
    "https://a.b/p#f": ("/p", "a.b", None),
    "https:///cart": (None, None, None),
    "/cart": (None, None, None),
    "ftp://a.b/x": (None, None, None),
    "https://a.b?x=/y": ("/y", "a.b?x=", "x=/y"),
    None: (None, None, None),
}


def test_url_parts(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    url = F.col("url")
    rows = df.select("url", text.url_path(url), text.url_host(url), text.url_query(url)).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == URLS


def test_strict_url_ends_host_at_query(spark):
    df = spark.createDataFrame([("https://a.b?x=/y",)], "url string")
    row = df.select(text.url_host(F.col("url"), strict=True), text.url_path(F.col("url"), strict=True)).first()
    assert tuple(row) == ("a.b", None)


def test_key_marks_null_and_joins_with_dash(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    expected = hashlib.md5(f"a-{keys.NULL_TOKEN}-3".encode()).hexdigest()
    assert df.select(keys.surrogate_key("x", "y", "z")).first()[0] == expected


def test_param_missing_repeated_and_typed(spark):
    df = ga4_frame(spark, [
        ga4("u", "2024-01-01 00:00:00", "page_view", params=[param("t", "first"), param("t", "second"), param("n", 5)]),
        ga4("u", "2024-01-01 00:00:01", "page_view"),
    ])
    rows = df.select(
        params.param_text("event_params", "t").alias("t"), params.param_long("event_params", "n").alias("n"),
        params.param_text("event_params", "n").alias("n_text"),
    ).collect()
    assert [tuple(r) for r in rows] == [("first", 5, None), (None, None, None)]


def test_repeated_param_fails_when_strict(spark):
    df = ga4_frame(spark, [ga4("u", "2024-01-01 00:00:00", "x", params=[param("t", "a"), param("t", "b")])])
    with pytest.raises(PySparkException, match="repeated event parameter"):
        df.select(params.param_text("event_params", "t", strict=True)).collect()


@pytest.mark.parametrize(("value", "lenient", "strict"), [(7, 7, None), ("7", 7, 7), ("abc", None, "error")])
def test_number_param(spark, value, lenient, strict):
    df = ga4_frame(spark, [ga4("u", "2024-01-01 00:00:00", "x", params=[param("m", value)])])
    assert df.select(params.param_number("event_params", "m")).first()[0] == lenient
    read = df.select(params.param_number("event_params", "m", strict=True))
    if strict == "error":
        with pytest.raises(PySparkException):
            read.collect()
    else:
        assert read.first()[0] == strict


def test_tolerant_numbers(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), ("",), ("12",), (None,)], "x string")
    rows = df.select(numbers.whole("x"), numbers.real("x")).collect()
    assert [tuple(r) for r in rows] == [(None, 12.5), (None, None), (None, None), (12, 12.0), (None, None)]


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (0, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(numbers.ratio("a", "b")).collect()] == [None, 0.5, None, None]


def test_contentsquare_flags(spark):
    rows = [{"event_id": str(i), "device_type": d, "is_first": f, "view_number": "1"} for i, (d, f) in enumerate(
        [("Mobile", "1"), ("DESKTOP", "0"), ("tablet", None), (None, "true")])]
    staged = staging.stage_cs_pageview(cs_frame(spark, "pageviews", rows))
    got = [tuple(r) for r in staged.select("device_is_mobile", "is_first_view").collect()]
    assert got == [(True, True), (False, False), (None, False), (None, False)]


def test_label_defaults(spark):
    df = spark.createDataFrame(
        [("google", "cpc"), (None, "cpc"), ("google", None), (None, None)], "traffic_source_source string, traffic_source_medium string"
    )
    labels = [r[0] for r in df.select(text.source_medium()).collect()]
    assert labels == ["google / cpc", "(direct) / cpc", "google / (none)", "(direct) / (none)"]
