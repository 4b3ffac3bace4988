"""Rows and runs at the edge: missing days, sources, feeds."""

from __future__ import annotations

import datetime as dt

import pytest

from shoptrail.config import Options
from shoptrail.operators import upsert as up
from shoptrail.plans import integration
from shoptrail.plans.run import Feeds, published, run_all
from shoptrail.sources import samples, tables

FOLDER = "/root/testdata/sf0.001"
DAY1, DAY2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows(spark, data):
    return spark.createDataFrame(data, "event_date date, source string, k int, v string")


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_full_rebuild_leaves_no_old_day(spark, tmp_path, mode):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        tables.write_days(rows(spark, [(DAY1, "a", 1, "x")]), path)
        tables.write_days(rows(spark, [(DAY2, "a", 2, "y")]), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.k for r in spark.read.parquet(path).collect()] == [2]


def test_rows_without_source_are_loaded(spark):
    data = rows(spark, [(DAY1, None, 1, "x"), (DAY1, "a", 2, "x"), (DAY2, "a", 3, "x"), (DAY1, "b", 4, "x"), (DAY2, None, 5, "x")])
    found = lambda marks: sorted(r.k for r in up.newer_than(data, marks).collect())
    assert found({"a": DAY1}) == [1, 3, 4, 5]
    assert found({"a": DAY1, None: DAY1}) == [3, 4, 5]


def test_rows_without_a_day_are_merged(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_days(rows(spark, [(DAY1, "a", 1, "old"), (None, "a", 2, "old"), (None, "a", 3, "old"), (DAY2, "a", 4, "old")]), path)
    target = tables.read_table(spark, path)
    merge = up.merge_by_key(target, rows(spark, [(None, "a", 2, "new"), (DAY1, "a", 3, "new")]), ["k"])
    assert merge.days == (DAY1, None)
    assert sorted((r.k, r.v) for r in merge.rows.collect()) == [(1, "old"), (2, "new"), (3, "new")]
    copy = str(tmp_path / "copy")
    merge.rows.write.parquet(copy)
    tables.replace_days(spark.read.parquet(copy), path)
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "old"), (2, "new"), (3, "new"), (4, "old")]
    tables.remove_days(spark, path, [None])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 3, 4]


def test_run_of_friction_events_alone(spark, tmp_path):
    feeds = Feeds(contentsquare={"rage_click": samples.contentsquare(spark, FOLDER, "rage_click")})
    run_all(spark, feeds, str(tmp_path), options=Options(as_of=DAY1))
    assert published(spark, str(tmp_path))["rage_click_fct"].count() > 0


def test_transactions_wanted_but_not_fed(spark):
    from shoptrail.plans import staging

    staged = staging.stage_cs_session(samples.contentsquare(spark, FOLDER, "sessions"))
    unified = integration.unify_sessions(spark, contentsquare=staged, options=Options(attach_transactions=True))
    assert unified.count() == staged.count()
