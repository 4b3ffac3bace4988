from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoptrail.operators import flow
from shoptrail.plans import facts, integration, staging
from tests.feeds import cs_frame, ga4, ga4_frame, param, same_rows


def view(user, ts, session, bundle, page):
    return ga4(user, ts, "page_view", session, bundle, params=[param("page_location", page)])


def test_navigation(spark):
    events = staging.stage_ga4_event(ga4_frame(spark, [
        view("u", "2024-01-01 10:00:00", 1, 0, "https://a.b/x"),
        view("u", "2024-01-01 10:00:45", 1, 1, "https://a.b/y?q=1"),
        view("u", "2024-01-01 10:02:00", 1, 2, "https://a.b/z"),
        view("u", "2024-01-01 10:01:00", None, 3, "https://a.b/n"),
        view("u", "2024-01-03 10:01:00", None, 4, "https://a.b/m"),
    ]))
    rows = facts.pageview_fct(integration.unify_pageviews(spark, events)).orderBy("ga_session_id", "pageview_ts").collect()
    got = [(r.ga_session_id, r.page_path, r.previous_page_location, r.time_on_page_seconds, r.page_number_in_session,
            r.total_pages_in_session, r.is_entrance, r.is_exit) for r in rows]
    assert got == [
        (None, "/n", None, 172800, 1, 2, 1, 0),
        (None, "/m", "https://a.b/n", None, 2, 2, 0, 1),
        ("1", "/x", None, 45, 1, 3, 1, 0),
        ("1", "/y", "https://a.b/x", 75, 2, 3, 0, 0),
        ("1", "/z", "https://a.b/y?q=1", None, 3, 3, 0, 1),
    ]


def test_engagement_and_flags(spark):
    events = staging.stage_ga4_event(ga4_frame(spark, [
        ga4("u", "2024-01-01 10:00:00", "page_view", 1, params=[
            param("engagement_time_msec", "1500"), param("session_engaged", "1"), param("entrances", 1)]),
        ga4("u", "2024-01-01 10:00:01", "page_view", 1, 1, params=[
            param("engagement_time_msec", 250), param("session_engaged", "0")]),
        ga4("u", "2024-01-01 10:00:02", "page_view", 1, 2, params=[param("engagement_time_msec", "abc")]),
    ]))
    rows = facts.pageview_fct(integration.unify_pageviews(spark, events)).orderBy("pageview_ts").collect()
    got = [(r.engagement_time_msec, r.engagement_time_seconds, r.entrances, r.is_engaged_session) for r in rows]
    assert got == [(1500, 1.5, 1, 1), (250, 0.25, 0, 0), (0, 0.0, 0, 0)]


def test_contentsquare_location_has_no_domain(spark):
    views = staging.stage_cs_pageview(cs_frame(spark, "pageviews", [
        {"event_id": "1", "user_id": "u", "session_id": "1", "time": "2024-01-01 10:00:00", "path": "/cart", "is_first": "1",
         "view_duration_msec": "1200", "window_height": "700"},
        {"event_id": "2", "user_id": "u", "session_id": "1", "time": "2024-01-01 10:01:00", "view_duration_msec": "12.5"},
    ]))
    first, second = facts.pageview_fct(integration.unify_pageviews(spark, contentsquare=views)).orderBy("pageview_ts").collect()
    assert (first.page_location, first.page_hostname, first.page_path, first.entrances) == ("https:///cart", None, None, 1)
    assert (first.engagement_time_msec, first.browser_viewheight, first.browser_family) == (1200, 700, None)
    assert (second.page_location, second.page_hostname, second.engagement_time_msec) == ("https:///", None, 0)


def views(spark, rows):
    schema = "source string, user_fk string, ga_session_id string, pageview_ts timestamp, pageview_pk string, page_location string"
    return spark.createDataFrame(rows, schema)


def some_views(seed, copies=0):
    """Views of which a third belongs to one group, with NULL keys and equal times."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for n in range(600):
        user = "hot" if n % 3 == 0 else rng.choice(["a", "b", None])
        session = None if user == "hot" else rng.choice(["1", "2", None])
        ts = start + dt.timedelta(seconds=rng.choice([0, 0, 0, rng.randrange(50)]))
        rows.append(("ga4", user, session, ts, f"{n:04d}", rng.choice(["x", "y", None])))
    return rows + [rows[0]] * copies


def one_window(rows):
    """The same columns from one window per group."""
    group = Window.partitionBy("source", "user_fk", "ga_session_id")
    ordered = group.orderBy("pageview_ts", "pageview_pk")
    return rows.withColumns({
        "next_page_ts": F.lead("pageview_ts").over(ordered),
        "previous_page_location": F.lag("page_location").over(ordered),
        "page_number_in_session": F.row_number().over(ordered).cast("bigint"),
        "total_pages_in_session": F.count(F.lit(1)).over(group),
    })


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("slice_seconds", [1, 7, 3600])
def test_slices_give_the_rows_of_one_window(spark, seed, slice_seconds):
    rows = views(spark, some_views(seed))
    same_rows(flow.page_flow(rows, slice_seconds=slice_seconds), one_window(rows))


def test_views_without_a_time_come_first(spark):
    rows = views(spark, [(*r[:3], r[3] if n % 5 else None, *r[4:]) for n, r in enumerate(some_views(3))])
    same_rows(flow.page_flow(rows, slice_seconds=5), one_window(rows))


def test_invariants(spark):
    rows = flow.page_flow(views(spark, some_views(5)), slice_seconds=3)
    assert rows.filter("page_number_in_session > total_pages_in_session").count() == 0
    groups = rows.groupBy("source", "user_fk", "ga_session_id").agg({"page_number_in_session": "max"}).collect()
    entrances = rows.filter("page_number_in_session = 1").count()
    assert entrances == len(groups)
