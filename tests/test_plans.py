"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from types import SimpleNamespace

import pytest

import catalog.spark_queries as catalog
from catalog.spark_queries import Feed
from shoptrail import schemas
from shoptrail.operators.funnel import conversion_funnel
from shoptrail.operators.users import user_totals
from shoptrail.plans import facts, integration, staging
from shoptrail.session import local_session, work_path, work_root
from shoptrail.sources import readers, samples, tables

FOLDER = "/root/testdata/sf0.001"
spread_table = samples.spread_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged_path(spark):
    """GA4's staged events as a table by day."""
    path = work_path(spark, "staged")
    tables.write_days(Feed(spark, FOLDER).ga4, path, ("event_name", "user_pseudo_id"))
    return path


def test_a_fact_reads_its_event_only(spark, staged_path):
    events = tables.read_table(spark, staged_path)
    text = plan(facts.add_to_cart_fct(integration.unify_add_to_cart(spark, events)))
    assert "EqualTo(event_name,add_to_cart)" in text
    assert "Exchange" not in text


def test_unused_columns_are_not_read(spark, staged_path):
    events = tables.read_table(spark, staged_path)
    sessions = facts.session_fct(integration.unify_sessions(spark, events)).select("user_fk", "events_per_session")
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan(sessions)).group(1)
    assert "items" not in schema and "ecommerce" not in schema and "event_params" not in schema


def test_the_day_filter_prunes_folders(spark, staged_path):
    events = tables.read_table(spark, staged_path).filter("event_date > date '2024-01-20'")
    assert "PartitionFilters: [isnotnull(event_date" in plan(conversion_funnel(events))


def test_raw_days_are_pruned_through_staging(spark):
    path = work_path(spark, "raw")
    Feed(spark, FOLDER).raw_ga4.write.partitionBy("event_date").parquet(path)
    staged = staging.stage_ga4_event(readers.read_ga4(spark, path)).filter("event_date > date '2024-01-20'")
    filters = re.search(r"PartitionFilters: \[(.*?)PushedFilters", plan(staged)).group(1)
    assert "event_date" in filters


def test_days_of_the_other_feeds_reach_their_scans(spark):
    path = work_path(spark, "raw")
    feed = Feed(spark, FOLDER)
    feed.raw_snowplow.write.parquet(f"{path}/snowplow")
    feed.cs("pageviews").write.parquet(f"{path}/pageviews")
    for rows, moment in (
        (readers.read_snowplow(spark, f"{path}/snowplow", "20240105", "20240120"), "collector_tstamp"),
        (readers.read_contentsquare(spark, path, "pageviews", "20240105", "20240120"), "time"),
    ):
        # The plan's text cuts long lists.
        pushed = re.search(r"PushedFilters: \[(.*)", plan(rows)).group(1)
        assert f"IsNotNull({moment}), Gre" in pushed


def test_navigation_moves_the_views_once(spark, staged_path):
    """The views move by (group, slice) and are joined there; apart from them only times and places
    move to make one row per slice, and these rows to be stitched per group."""
    text = plan(facts.pageview_fct(integration.unify_pageviews(spark, tables.read_table(spark, staged_path))))
    exchanges = re.findall(r"Exchange hashpartitioning\((.*)", text)
    assert len(exchanges) == 3 and sum("_slice" in e for e in exchanges) == 2
    assert "rangepartitioning" not in text


def test_distinct_counts_do_not_copy_rows(spark, staged_path):
    events = tables.read_table(spark, staged_path)
    sessions = facts.session_fct(integration.unify_sessions(spark, events))
    for df in (conversion_funnel(events), user_totals(sessions)):
        assert "Expand" not in plan(df)
    assert plan(conversion_funnel(events)).count("FileScan") == 1


def test_sessions_are_combined_before_their_exchange(spark, staged_path):
    text = plan(integration.unify_sessions(spark, tables.read_table(spark, staged_path)))
    assert text.count("Exchange") == 1
    assert "partial_min" in text[text.index("Exchange"):]


@pytest.mark.parametrize("name", ["session_fct", "pageview_fct", "purchase_fct", "user_dim", "conversion_funnel_fct"])
def test_no_cross_products_and_no_python(spark, name):
    text = plan(Feed(spark, FOLDER).fact(name))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert word not in text


def test_tables_are_laid_out_by_day(spark, staged_path):
    assert tables.read_table(spark, staged_path).inputFiles()[0].count("event_date=") == 1
    assert set(tables.read_table(spark, staged_path).columns) >= set(schemas.DEVICE)


def test_work_folder_is_the_one_the_session_names(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert local_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


class _Unnamed:
    """A session that names no checkpoint folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    def __init__(self, master):
        self.sparkContext = SimpleNamespace(
            master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: "set"
        )


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_root(_Unnamed("spark://host:7077"))
    local = _Unnamed("local[2]")
    assert work_root(local) == work_root(local)


def test_page_flow_shuffles_its_rows_once(spark):
    """One exchange and one window pass over whole rows; the other scan feeds small rows per slice."""
    from shoptrail.operators.flow import page_flow

    path = work_path(spark, "views")
    spark.range(2000).selectExpr(
        "'x' as source", "cast(id % 7 as string) as user_fk", "cast(id % 50 as string) as ga_session_id", "timestamp_seconds(id * 60) as pageview_ts",
        "cast(id as string) as pageview_pk", "'p' as page_location", "repeat('wide', 9) as wide",
    ).write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(page_flow(spark.read.parquet(path)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert [("wide" in line) for line in scans].count(True) == 1
    assert sum("row_number()" in line and "Window" in line for line in text.split("\n")) == 1
    # From the window down to the join that brings the slices' values no row is shuffled again.
    below = text[text.index("row_number()"):]
    assert below.index("Join") < below.index("Exchange")


def test_untimed_views_are_spread_by_their_key(spark):
    from pyspark.sql import functions as F

    from shoptrail.operators.flow import _untimed_slice

    keys = ["", "0", "0a", "0ab", "0b", "f", "ff", "é", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.orderBy("k").select(_untimed_slice(df, "k")).collect()]
    assert got == sorted(got) and len(set(got)) == 8
    assert df.select(F.max(_untimed_slice(df, "k"))).first()[0] < 0


def test_readers_of_other_columns_do_not_stitch_page_flow(spark):
    views = Feed(spark, FOLDER).fact("pageview_fct")
    for df in (views.groupBy("page_path").count(), views.select("pageview_pk", "largest_contentful_paint")):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in text and "Window" not in text
    assert "Join" in views._jdf.queryExecution().optimizedPlan().toString()


def test_ga4_rows_are_gathered_by_day_before_they_are_nested(spark):
    """The shuffle and the sort see plain rows, and the writer finds the days sorted."""
    text = samples.ga4_events_by_day(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("event_params") < text.index("Sort [event_date") < text.index("RebalancePartitions")
    assert "event_params" not in text[text.index("RebalancePartitions"):]


def test_a_feed_copies_its_own_table_only(spark, monkeypatch):
    copied = []
    monkeypatch.setattr(catalog, "STORED", {})
    monkeypatch.setattr(samples, "spread_table", lambda spark, folder, name, target: (copied.append(name), spread_table(spark, folder, name, target)))
    feed = Feed(spark, FOLDER)
    feed.raw_ga4, feed.cs("pageviews"), feed.cs(next(iter(schemas.CONTENTSQUARE_SIGNALS)))
    assert copied == ["events"]
    feed.cs("rage_click"), feed.raw_snowplow
    assert copied == ["events", "lineitem", "orders"]


def test_a_copy_has_more_files_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(samples, "ROWS_A_FILE", 100)
    path = work_path(spark, "spread")
    samples.spread_table(spark, FOLDER, "orders", path)
    copy = spark.read.parquet(f"{path}/orders.parquet")
    assert len(copy.inputFiles()) == 16 and copy.exceptAll(spark.read.parquet(f"{FOLDER}/orders.parquet")).isEmpty()


def test_conditions_on_parameters_parse_no_json(spark):
    """a condition on a feed's session id was pushed down to the plain events and parsed their JSON text 36 times a row."""
    path = work_path(spark, "spread")
    spread_table(spark, FOLDER, "events", path)
    events = staging.stage_ga4_event(samples.ga4_events(spark, path))
    text = events.filter("ga_session_id is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in text and "get_json_object" not in text
    whole = staging.stage_ga4_event(samples.ga4_events(spark, FOLDER))
    assert events.drop("event_params", "items").exceptAll(whole.drop("event_params", "items")).isEmpty() and events.count() == whole.count()
