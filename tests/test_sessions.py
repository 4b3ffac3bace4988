from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoptrail.config import Options, Sources
from shoptrail.plans import facts, integration, staging
from tests.feeds import cs_frame, ga4, ga4_frame, param, snowplow, snowplow_frame


def staged(spark, rows):
    return staging.stage_ga4_event(ga4_frame(spark, rows))


def test_session_over_midnight_has_a_row_per_day(spark):
    events = staged(spark, [
        ga4("u", "2024-01-01 23:59:00", "page_view", 7),
        ga4("u", "2024-01-02 00:01:30", "page_view", 7, bundle=1),
        ga4("u", "2024-01-02 00:02:00", "scroll", 7, bundle=2),
    ])
    rows = facts.session_fct(integration.unify_sessions(spark, events)).orderBy("event_date").collect()
    assert [(r.event_date, r.session_duration_seconds, r.page_views_per_session, r.events_per_session) for r in rows] == [
        (dt.date(2024, 1, 1), 0, 1, 1), (dt.date(2024, 1, 2), 30, 1, 2),
    ]
    whole = integration.unify_sessions(spark, events, options=Options(session_grain="session")).collect()
    assert [(r.event_date, r.session_duration_seconds, r.events_per_session) for r in whole] == [(dt.date(2024, 1, 1), 180, 3)]


def test_events_without_session_are_left_out(spark):
    events = staged(spark, [ga4("u", "2024-01-01 10:00:00", "page_view")])
    assert integration.unify_sessions(spark, events).count() == 0
    assert integration.unify_pageviews(spark, events).count() == 1


def test_engagement_revenue_and_conversion(spark):
    events = staged(spark, [
        ga4("u", "2024-01-01 10:00:00", "page_view", 1, params=[param("engagement_time_msec", 100)]),
        ga4("u", "2024-01-01 10:00:10", "page_view", 1, 1, params=[param("engagement_time_msec", "50")]),
        ga4("u", "2024-01-01 10:00:20", "page_view", 1, 2, params=[param("engagement_time_msec", "abc")]),
        ga4("u", "2024-01-01 10:00:30", "purchase", 1, 3, ecommerce={"purchase_revenue_in_usd": 9.5}),
        ga4("u", "2024-01-01 10:00:40", "purchase", 1, 4),
        ga4("v", "2024-01-01 10:00:00", "purchase", 2, 5),
        ga4("w", "2024-01-01 10:00:00", "scroll", 3, 6),
    ])
    rows = {r.user_fk: r for r in integration.unify_sessions(spark, events).collect()}
    u = rows["u"]
    assert (u.session_engagement_time_msec, u.purchase_events_per_session, u.purchase_revenue_per_session) == (150, 2, 9.5)
    assert rows["v"].purchase_revenue_per_session is None
    assert (rows["w"].purchase_revenue_per_session, rows["w"].is_conversion_session) == (0.0, 0)
    assert u.is_conversion_session == rows["v"].is_conversion_session == 1


def test_strict_engagement_reads_text_only(spark):
    events = staged(spark, [
        ga4("u", "2024-01-01 10:00:00", "x", 1, params=[param("engagement_time_msec", 100)]),
        ga4("u", "2024-01-01 10:00:10", "x", 1, 1, params=[param("engagement_time_msec", "50")]),
    ])
    strict = integration.unify_sessions(spark, events, options=Options(strict_params=True))
    assert strict.first().session_engagement_time_msec == 50


def test_context_is_the_first_known_value(spark):
    events = staged(spark, [
        ga4("u", "2024-01-01 10:00:00", "x", 1, geo={"city": None, "country": "A"}),
        ga4("u", "2024-01-01 10:00:10", "x", 1, 1, geo={"city": "Late", "country": "B"}),
        ga4("u", "2024-01-01 10:00:10", "x", 1, 2, geo={"city": "Early", "country": "B"}),
    ])
    row = integration.unify_sessions(spark, events).first()
    assert (row.geo_country, row.geo_city, row.geo_region) == ("A", "Early", None)


def test_same_ids_in_two_sources_stay_apart(spark):
    one = staged(spark, [ga4("u", "2024-01-01 10:00:00", "page_view", 7)])
    two = staging.stage_snowplow_event(snowplow_frame(spark, [
        snowplow("e1", "u", "2024-01-01 10:00:00", "page_view", "7", ecommerce={"value": 3.0}),
    ]))
    sessions = facts.session_fct(integration.unify_sessions(spark, one, two))
    assert sessions.count() == sessions.select("session_pk").distinct().count() == 2


@pytest.mark.parametrize("sources", [Sources(ga4=False), Sources(False, False, False)])
def test_switched_off_sources(spark, sources):
    events = staged(spark, [ga4("u", "2024-01-01 10:00:00", "purchase", 7, items=[{"item_id": "a"}])])
    options = Options(sources=sources)
    for unify in (integration.unify_sessions, integration.unify_pageviews, integration.unify_add_to_cart,
                  integration.unify_purchases, integration.unify_product_views):
        empty = unify(spark, events, options=options)
        assert empty.count() == 0
        assert empty.dtypes == unify(spark, events).dtypes


def test_contentsquare_sessions(spark):
    sessions = staging.stage_cs_session(cs_frame(spark, "sessions", [
        {"time": "2024-01-01 10:00:00", "user_id": "u", "session_id": "9", "session_duration": "90",
         "session_number_of_views": "4", "frustration_score": "12.5", "looping_index": "3"},
        {"time": "2024-01-01 11:00:00", "user_id": "u", "session_id": "10", "session_duration": "abc"},
    ]))
    row, other = integration.unify_sessions(spark, contentsquare=sessions).orderBy("session_start_ts").collect()
    assert row.session_end_ts - row.session_start_ts == dt.timedelta(seconds=90)
    assert (row.page_views_per_session, row.events_per_session, row.frustration_score, row.looping_index) == (4, 4, None, 3)
    assert (row.is_conversion_session, row.purchase_revenue_per_session) == (0, None)
    assert (other.session_end_ts, other.session_duration_seconds) == (None, None)


def test_transactions_attach_to_their_session(spark):
    sessions = staging.stage_cs_session(cs_frame(spark, "sessions", [
        {"time": "2024-01-01 10:00:00", "user_id": "u", "session_id": "9"},
        {"time": "2024-01-01 11:00:00", "user_id": "v", "session_id": "9"},
    ]))
    bought = staging.stage_cs_purchase(cs_frame(spark, "ecommerce_transactions", [
        {"event_id": "1", "user_id": "u", "session_id": "9", "time": "2024-01-01 10:01:00", "transaction_amount": 5.0},
        {"event_id": "2", "user_id": "u", "session_id": "9", "time": "2024-01-01 10:02:00", "transaction_amount": 2.0},
    ]))
    plain = integration.unify_sessions(spark, contentsquare=sessions, cs_transactions=bought)
    assert [r.is_conversion_session for r in plain.collect()] == [0, 0]
    attached = integration.unify_sessions(
        spark, contentsquare=sessions, cs_transactions=bought, options=Options(attach_transactions=True)
    )
    rows = {r.user_fk: r for r in attached.collect()}
    assert (rows["u"].purchase_events_per_session, rows["u"].purchase_revenue_per_session) == (2, 7.0)
    assert (rows["u"].is_conversion_session, rows["v"].is_conversion_session) == (1, 0)


def test_source_rows_add_up(spark):
    one = staged(spark, [ga4("u", "2024-01-01 10:00:00", "page_view", 7, bundle=i) for i in range(5)])
    two = staging.stage_snowplow_event(snowplow_frame(spark, [
        snowplow(f"e{i}", "u", "2024-01-01 10:00:00", "page_view") for i in range(3)
    ]))
    counts = integration.unify_pageviews(spark, one, two).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    assert {r.source: r.n for r in counts.collect()} == {"ga4": 5, "snowplow": 3}
