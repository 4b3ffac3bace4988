"""Per-user totals, attribution and segments (AGG-7..11, FCT-6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.money import money
from shoptrail.functions.numbers import ratio

_TOUCH = {
    "source": "traffic_source_source",
    "medium": "traffic_source_medium",
    "campaign": "traffic_source_name",
    "date": "event_date",
}
_CONTEXT = {
    "device_category": "device_category",
    "device_os": "device_operating_system",
    "geo_country": "geo_country",
    "geo_region": "geo_region",
    "geo_city": "geo_city",
}
_REVENUE = "purchase_revenue_per_session"
_SUMS = (
    "page_views_per_session", "events_per_session", "session_duration_seconds",
    "session_engagement_time_msec", "purchase_events_per_session", _REVENUE,
)
_AVERAGED = ("session_duration_seconds", "page_views_per_session")


def user_totals(sessions: DataFrame) -> DataFrame:
    """One row per user: totals, distinct sessions, first and last touch.

    The two distinct counts are taken in two steps, first per (user, session
    id) and then per user, so sessions are not copied once per distinct count
    and a user with very many sessions is spread over tasks by session id.
    Revenue is added up as decimals, so that it does not depend on the order of
    the sessions; a user with an amount of more than nine places gets the plain sum.
    Touches are the session of the smallest and of the largest (date, start,
    key), an aggregate and not a sorted list.
    """
    order = [F.col("event_date").alias("day"), F.col("session_start_ts").alias("start"), F.col("session_pk").alias("key")]
    # The order leads the struct, so min and max of it are the two touches.
    touch = F.struct(
        *order,
        *[F.col(c).alias(f"touch_{n}") for n, c in _TOUCH.items()],
        *[F.col(c).alias(f"context_{n}") for n, c in _CONTEXT.items()],
    )
    revenue, exact = F.col(_REVENUE), F.col("_exact")
    # Not so near its decimal that they are one amount: a number of more places, or of no size that fits.
    other = F.coalesce(F.abs(exact.cast("double") - revenue) > F.abs(revenue) * 1e-12, revenue.isNotNull())
    per_session = sessions.withColumn("_exact", money(_REVENUE)).groupBy("user_fk", "ga_session_id").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.try_sum("_exact").alias("_exact"),
        F.count_if(other).alias("_inexact"),
        *[F.count(c).alias(f"{c}_known") for c in _AVERAGED],
        F.max("is_conversion_session").alias("converted"),
        F.min(touch).alias("first"),
        F.max(touch).alias("last"),
    )
    counted = F.col("ga_session_id").isNotNull()
    lost = F.sum("_inexact") + F.count_if(revenue.isNotNull() & exact.isNull())
    total = F.when(lost == 0, F.try_sum("_exact").cast("string").cast("double"))
    return per_session.groupBy("user_fk").agg(
        F.count_if(counted).alias("total_sessions"),
        F.count_if(counted & (F.col("converted") == 1)).alias("conversion_sessions"),
        *[(F.coalesce(total, F.sum(c)) if c == _REVENUE else F.sum(c)).alias(c) for c in _SUMS],
        *[F.sum(f"{c}_known").alias(f"{c}_known") for c in _AVERAGED],
        F.max("converted").alias("has_ever_purchased"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


def recency_segment(days: Column) -> Column:
    return (
        F.when(days <= 7, "Active (Last 7 days)")
        .when(days <= 30, "Recent (Last 30 days)")
        .when(days <= 90, "Dormant (Last 90 days)")
        .otherwise("Inactive (90+ days)")
    )


def frequency_segment(sessions: Column) -> Column:
    return (
        F.when(sessions >= 10, "High Frequency (10+ sessions)")
        .when(sessions >= 5, "Medium Frequency (5-9 sessions)")
        .when(sessions >= 2, "Low Frequency (2-4 sessions)")
        .otherwise("Single Session")
    )


def monetary_segment(revenue: Column) -> Column:
    return (
        F.when(revenue >= 500, "High Value ($500+)")
        .when(revenue >= 100, "Medium Value ($100-$499)")
        .when(revenue > 0, "Low Value ($1-$99)")
        .otherwise("No Revenue")
    )


def user_type(purchases: Column, sessions: Column) -> Column:
    return (
        F.when(purchases > 1, "Repeat Buyer")
        .when(purchases == 1, "One-Time Buyer")
        .when(sessions > 1, "Engaged Non-Buyer")
        .otherwise("Single Visit")
    )


def user_dimension(sessions: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """FCT-6: one row per user over all sources.

    Recency counts from ``as_of``, by default from the day of the run.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    users = user_totals(sessions).select(
        F.col("user_fk").alias("user_pk"),
        "total_sessions",
        "conversion_sessions",
        "has_ever_purchased",
        F.col("page_views_per_session").alias("total_page_views"),
        F.col("events_per_session").alias("total_events"),
        F.col("session_duration_seconds").alias("total_session_duration_seconds"),
        (F.col("session_engagement_time_msec") / F.lit(1000.0)).alias("total_engagement_time_seconds"),
        ratio("session_duration_seconds", "session_duration_seconds_known").alias("avg_session_duration_seconds"),
        ratio("page_views_per_session", "page_views_per_session_known").alias("avg_page_views_per_session"),
        F.col("purchase_events_per_session").alias("total_purchases"),
        F.col("purchase_revenue_per_session").alias("total_revenue"),
        F.col("first.day").alias("first_seen_date"),
        F.col("last.day").alias("last_seen_date"),
        *[F.col(f"first.touch_{n}").alias(f"first_touch_{n}") for n in _TOUCH],
        *[F.col(f"last.touch_{n}").alias(f"last_touch_{n}") for n in _TOUCH],
        *[F.col(f"last.context_{n}").alias(f"latest_{n}") for n in _CONTEXT],
    ).withColumn("days_since_last_visit", F.datediff(today, "last_seen_date").cast("bigint"))
    return users.select(
        "user_pk",
        "total_sessions", "total_page_views", "total_events",
        ratio("total_page_views", "total_sessions").alias("pages_per_session"),
        "avg_page_views_per_session",
        "total_session_duration_seconds", "avg_session_duration_seconds", "total_engagement_time_seconds",
        ratio("total_engagement_time_seconds", "total_sessions").alias("avg_engagement_per_session"),
        "has_ever_purchased", "total_purchases", "conversion_sessions",
        ratio("conversion_sessions", "total_sessions").alias("user_conversion_rate"),
        "total_revenue",
        ratio("total_revenue", "total_sessions").alias("revenue_per_session"),
        ratio("total_revenue", "total_purchases").alias("average_order_value"),
        "first_seen_date", "last_seen_date",
        F.datediff("last_seen_date", "first_seen_date").cast("bigint").alias("user_lifetime_days"),
        "days_since_last_visit",
        recency_segment(F.col("days_since_last_visit")).alias("recency_segment"),
        frequency_segment(F.col("total_sessions")).alias("frequency_segment"),
        monetary_segment(F.col("total_revenue")).alias("monetary_segment"),
        user_type(F.col("total_purchases"), F.col("total_sessions")).alias("user_type"),
        *[f"first_touch_{n}" for n in _TOUCH],
        *[f"last_touch_{n}" for n in _TOUCH],
        *[f"latest_{n}" for n in _CONTEXT],
    )
