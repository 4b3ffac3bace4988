"""Event rows to session rows (INT-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.numbers import first_known, whole_units


def sessionise(
    events: DataFrame,
    engagement: Column,
    revenue: Column,
    context: list[str],
    grain: str = "date",
    day: Column | None = None,
) -> DataFrame:
    """One row per day, user and session id; ``grain='session'`` drops the day.

    Events without a session id are left out. Every measure is an aggregate
    Spark combines before the shuffle, so a session holding a large part of
    all events costs its rows no more than the others. A stream names its
    ``day`` as a time window, so that finished days can leave its state.
    """
    by = ["user_pseudo_id", "ga_session_id"]
    dates = []
    if grain == "date":
        by.insert(0, F.col("event_date") if day is None else day)
    else:
        dates = [F.min("event_date").alias("event_date")]
    bought = F.col("event_name") == "purchase"
    sessions = (
        events.filter(F.col("ga_session_id").isNotNull())
        .withColumns({"_engagement": engagement, "_revenue": F.when(bought, revenue).otherwise(F.lit(0.0))})
        .groupBy(*by)
        .agg(
            *dates,
            F.min("event_ts").alias("session_start_ts"),
            F.max("event_ts").alias("session_end_ts"),
            F.count_if(F.col("event_name") == "page_view").alias("page_views_per_session"),
            F.count(F.lit(1)).alias("events_per_session"),
            F.sum("_engagement").alias("session_engagement_time_msec"),
            F.count_if(bought).alias("purchase_events_per_session"),
            F.sum("_revenue").alias("purchase_revenue_per_session"),
            *[first_known(name).alias(name) for name in context],
        )
    )
    return sessions.withColumns({
        "user_fk": F.col("user_pseudo_id"),
        "ga_session_id": F.col("ga_session_id").cast("string"),
        "session_duration_seconds": whole_units("SECOND", "session_start_ts", "session_end_ts"),
        "is_conversion_session": (F.col("purchase_events_per_session") > 0).cast("bigint"),
    })
