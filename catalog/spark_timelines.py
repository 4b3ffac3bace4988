"""Registered queries that follow users through time: as-of and interval joins, sessions by pause."""

from __future__ import annotations

from pyspark.sql import DataFrame

from catalog.spark_queries import Feed, query
from shoptrail.plans import journeys


@query("last_touch_before_purchase")
def _(feed: Feed) -> DataFrame:
    return journeys.last_touch_before_purchase(feed.purchases, feed.published("session_fct"))


@query("friction_per_page_view")
def _(feed: Feed) -> DataFrame:
    return journeys.friction_per_page_view(feed.published("pageview_fct"), feed.published("rage_click_fct"), feed.published("js_error_fct"))


@query("sessions_by_gap")
def _(feed: Feed) -> DataFrame:
    return journeys.sessions_by_gap(feed.ga4)
