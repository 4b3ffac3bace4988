"""Every registered query against DuckDB, all rows and all columns."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from catalog.compare import connect, difference
from catalog.duck_queries import SQL
from catalog.spark_queries import QUERIES, STORED, Feed
from shoptrail.plans import checks
from shoptrail.plans.run import Run

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, FOLDER, name, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_few_reads_take_feeds_from_the_plain_tables(spark, tmp_path):
    """Queries that read a feed once do not write all its columns first; a written feed is read, with the same rows."""
    folder = str(tmp_path / "data")
    os.symlink("/root/testdata/sf0.001", folder)
    names = ("source_union", "add_to_cart_fct", "purchase_fct", "recency_today")
    derived = {n: sorted(map(str, QUERIES[n](spark, folder).collect())) for n in names}
    assert not {name for _, of, name in STORED if of == folder} - {"table events", "table orders", "table lineitem"}
    feed = Feed(spark, folder)
    assert [feed.raw_ga4, feed.raw_snowplow, feed.cs("sessions"), feed.cs("pageviews")]
    assert {n: sorted(map(str, QUERIES[n](spark, folder).collect())) for n in names} == derived


def test_warehouse_tests_build_each_fact_once(spark, tmp_path):
    """every test of a fact reads one written copy; facts were built anew for each, from feeds written in all columns."""
    folder = str(tmp_path / "data")
    os.symlink("/root/testdata/sf0.001", folder)
    files = QUERIES["tests_warehouse"](spark, folder).inputFiles()
    assert {file.split("/")[-2].rsplit("-", 1)[0] for file in files} == set(checks.WAREHOUSE)
    assert not {name for _, of, name in STORED if of == folder} - {"table events", "table orders", "table lineitem"}


def test_an_incremental_query_loads_its_own_table_only(spark, tmp_path, monkeypatch):
    """each of the two loaded the other's table as well and threw it away, from feeds written in all columns."""
    folder = str(tmp_path / "data")
    os.symlink("/root/testdata/sf0.001", folder)
    published = []
    publish = Run.publish
    monkeypatch.setattr(Run, "publish", lambda run, layer, name, *a, **k: (published.append(name), publish(run, layer, name, *a, **k))[1])
    QUERIES["incremental_sessions"](spark, folder)
    QUERIES["incremental_pageviews"](spark, folder)
    assert published == ["session_fct"] * 2 + ["pageview_fct"] * 2
    assert not {name for _, of, name in STORED if of == folder} - {"table events"}
