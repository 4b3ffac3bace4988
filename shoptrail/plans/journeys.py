"""Users' ways through time: what led to a purchase, what went wrong on a page, sessions by pause."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.keys import surrogate_key
from shoptrail.functions.numbers import whole_units
from shoptrail.functions.text import source_medium
from shoptrail.operators.asof import as_of
from shoptrail.operators.gaps import gap_sessions
from shoptrail.operators.intervals import holding
from shoptrail.operators.items import one_row_per_item

# A view without a next one counts as open for so long, as a session is after its last event.
OPEN_VIEW_SECONDS = 1800


def last_touch_before_purchase(purchases: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row per bought item with the user's latest session, over all sources, that began at or before the purchase.

    The join is made per purchase, before the items are unnested. Of sessions
    that began at one time the one with the largest key counts; purchases of no
    known user, or before the user's first session, have none.
    """
    touches = sessions.withColumn("traffic_source_full", source_medium())
    values = ("session_pk", "source", "session_start_ts", "traffic_source_full")
    # What later steps need, so that the sort does not carry the rest.
    slim = purchases.select("source", "event_pk", "user_fk", "event_ts", "transaction_id", "items")
    touched = as_of(slim, touches, ["user_fk"], "event_ts", "session_start_ts", "session_pk", values)
    return one_row_per_item(touched).select(
        surrogate_key("source", "event_pk", "item_id", "item_offset").alias("purchase_pk"),
        "source", "user_fk", F.col("event_ts").alias("purchase_ts"), "transaction_id", "item_id",
        "item_revenue", F.col("item_revenue_in_usd").alias("item_revenue_usd"),
        "last_session_pk", "last_source", "last_session_start_ts", "last_traffic_source_full",
        whole_units("SECOND", "last_session_start_ts", "event_ts").alias("seconds_since_session_start"),
    )


def friction_per_page_view(views: DataFrame, rage_clicks: DataFrame, script_errors: DataFrame, open_seconds: int = OPEN_VIEW_SECONDS) -> DataFrame:
    """One row per page view that had friction: rage clicks and script errors of its user from its time until the next view.

    The last view of a session has no next one and counts as open for ``open_seconds``. Views of
    one user in several sessions or sources may overlap; an event counts for each that holds it.
    """
    end = F.coalesce(F.timestamp_add("SECOND", F.col("time_on_page_seconds"), F.col("pageview_ts")), F.timestamp_add("SECOND", F.lit(open_seconds), F.col("pageview_ts")))
    spans = views.select("pageview_pk", "source", F.col("user_fk").alias("of"), "page_path", "pageview_ts", end.alias("view_end_ts"))
    events = rage_clicks.select(F.col("user_fk").alias("user"), F.col("rage_click_ts").alias("at"), F.col("click_count").alias("clicks"), F.lit(1).alias("rage"))
    events = events.unionByName(script_errors.select(F.col("user_fk").alias("user"), F.col("error_ts").alias("at"), F.lit(None).cast("double").alias("clicks"), F.lit(0).alias("rage")))
    met = holding(events.withColumnRenamed("user", "of"), spans, ["of"], "at", "pageview_ts", "view_end_ts", ("pageview_pk", "source", "page_path", "pageview_ts", "view_end_ts"))
    return met.groupBy("pageview_pk", "source", F.col("of").alias("user_fk"), "page_path", "pageview_ts", "view_end_ts").agg(
        F.sum("rage").cast("long").alias("rage_clicks"),
        F.sum(1 - F.col("rage")).cast("long").alias("script_errors"),
        F.min("at").alias("first_friction_ts"),
        F.max("at").alias("last_friction_ts"),
    )


def sessions_by_gap(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Sessions of the events that came without a session id, per user, ended by a pause."""
    lost = events.filter(F.col("ga_session_id").isNull()).select(F.col("user_pseudo_id").alias("user_fk"), "event_ts", "event_name")
    counts = {"page_views": F.col("event_name") == "page_view", "purchases": F.col("event_name") == "purchase"}
    found = gap_sessions(lost, ["user_fk"], "event_ts", gap_seconds, counts)
    return found.select(
        "user_fk", "session_number", "session_start_ts", "session_end_ts",
        whole_units("SECOND", "session_start_ts", "session_end_ts").alias("session_duration_seconds"), "events", "page_views", "purchases",
    )
