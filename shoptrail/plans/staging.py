"""Staging jobs: rename, cast and flatten one raw feed each (STG-1..11).

All of them are plain projections, so a filter or a column choice made further
up reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail import schemas
from shoptrail.functions.keys import surrogate_key
from shoptrail.functions.numbers import day_from_text, real, whole
from shoptrail.functions.params import param_long
from shoptrail.functions.text import mobile_flag, text_flag


def _renamed(names: dict[str, str]) -> list[Column]:
    """``{new name: raw column}`` as a projection."""
    return [F.expr(f"{raw} as {new}") for new, raw in names.items()]


def _unknown(fields: dict[str, str], *names: str) -> list[Column]:
    return [F.expr(f"cast(null as {fields[name]}) as {name}") for name in names]


# ------------------------------------------------------------------------ GA4
def stage_ga4_event(events: DataFrame, strict: bool = False) -> DataFrame:
    """STG-1: one row per GA4 event."""
    return events.select(
        surrogate_key("event_timestamp", "user_pseudo_id", "event_name", "event_bundle_sequence_id").alias("event_pk"),
        day_from_text("event_date").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        "user_pseudo_id",
        param_long("event_params", "ga_session_id", strict).alias("ga_session_id"),
        "event_name",
        "event_bundle_sequence_id",
        "event_params",
        "ecommerce",
        "items",
        *_renamed({
            "traffic_source_name": "traffic_source.name",
            "traffic_source_medium": "traffic_source.medium",
            "traffic_source_source": "traffic_source.source",
            "device_category": "device.category",
            "device_operating_system": "device.operating_system",
            "device_browser": "device.web_info.browser",
            "device_language": "device.language",
        }),
        *_renamed({f"geo_{part}": f"geo.{part}" for part in ("continent", "sub_continent", "country", "region", "city")}),
    )


# ------------------------------------------------------------------- Snowplow
def stage_snowplow_event(events: DataFrame) -> DataFrame:
    """STG-2: one row per Snowplow event, under GA4's names."""
    return events.select(
        F.col("event_id").alias("event_pk"),
        F.to_date("collector_tstamp").alias("event_date"),
        F.col("collector_tstamp").alias("event_ts"),
        "user_pseudo_id",
        F.col("session_id").cast("string").alias("ga_session_id"),
        "user_id", "domain_userid", "network_userid",
        "event_name", "event_id", "app_id", "platform", "debug_mode",
        "ecommerce",
        F.col("ecommerce.items").alias("items"),
        *_renamed({
            "traffic_source_source": "traffic_source.source",
            "traffic_source_medium": "traffic_source.medium",
            "traffic_source_name": "traffic_source.campaign",
            "traffic_source_content": "traffic_source.content",
            "traffic_source_term": "traffic_source.term",
            "device_category": "device.category",
            "device_operating_system": "device.os",
            "device_browser": "device.browser",
            "device_language": "br_lang",
        }),
        *_renamed({
            "browser_family": "br_family",
            "browser_name": "br_name",
            "browser_version": "br_version",
            "browser_type": "br_type",
            "browser_renderengine": "br_renderengine",
            "browser_colordepth": "br_colordepth",
            "browser_viewheight": "br_viewheight",
            "browser_viewwidth": "br_viewwidth",
            "browser_cookies_enabled": "br_cookies",
            "browser_supports_pdf": "br_features_pdf",
            "browser_supports_quicktime": "br_features_quicktime",
        }),
        *_renamed({
            "device_type": "dvce_type",
            "device_is_mobile": "dvce_ismobile",
            "device_screen_height": "dvce_screenheight",
            "device_screen_width": "dvce_screenwidth",
            "device_created_ts": "dvce_created_tstamp",
        }),
        "os_name", "os_family", "os_manufacturer", "os_timezone",
        *_unknown(schemas.GEO, "geo_continent", "geo_sub_continent"),
        *_renamed({
            f"geo_{part}": f"geo.{part}"
            for part in ("country", "region", "region_name", "city", "zipcode", "latitude", "longitude", "timezone")
        }),
        "page_location", "page_url", "page_title", "page_referrer",
        "page_urlhost", "page_urlpath", "page_urlquery", "page_urlfragment",
        "engagement_time_msec",
        *_renamed({
            f"user_{part}": f"user_properties.{part}"
            for part in ("customer_segment", "loyalty_tier", "subscription_status")
        }),
        F.col("domain_sessionidx").alias("session_index"),
        "user_ipaddress",
        *_renamed({
            f"ga4_adapter_{part}": f"ga4_adapter.{part}"
            for part in ("source", "original_event_name", "data_layer_version")
        }),
        "etl_tstamp",
        *_renamed({f"{part}_version": f"v_{part}" for part in ("tracker", "collector", "etl")}),
    )


# -------------------------------------------------------------- ContentSquare
def _cs_head() -> list[Column]:
    """Key, time and ids, the same in every ContentSquare event table."""
    return [
        surrogate_key("event_id").alias("event_pk"),
        F.to_date("time").alias("event_date"),
        F.col("time").alias("event_ts"),
        F.col("user_id").cast("string").alias("user_pseudo_id"),
        F.col("session_id").cast("string").alias("ga_session_id"),
        F.col("event_id").cast("string").alias("event_id"),
    ]


def _cs_pageview_id() -> Column:
    return F.col("pageview_id").cast("string").alias("pageview_id")


def _cs_page(*parts: str) -> list[Column]:
    return [F.col(f"`{part}`").alias(f"page_{part}") for part in parts]


def _cs_utm() -> list[Column]:
    return [
        *_unknown(schemas.TRAFFIC, "traffic_source_name"),
        *[F.col(f"utm_{part}").alias(f"traffic_source_{part}") for part in ("medium", "source", "content", "term")],
    ]


def _cs_device() -> list[Column]:
    return [F.col("platform").alias("device_operating_system"), F.col("device_type"), mobile_flag().alias("device_is_mobile")]


def _cs_geo() -> list[Column]:
    return [F.col(part).alias(f"geo_{part}") for part in ("country", "region", "city")]


def _cs_full_device(browser: bool) -> list[Column]:
    known = F.col("browser") if browser else F.lit(None).cast("string")
    return [
        *_unknown(schemas.DEVICE, "device_category", "device_language"),
        F.col("platform").alias("device_operating_system"),
        known.alias("device_browser"),
        known.alias("browser_name"),
        *_unknown(schemas.DEVICE_EXTRA, "browser_family", "browser_version"),
        F.col("device_type"),
        mobile_flag().alias("device_is_mobile"),
        *_unknown(schemas.DEVICE_EXTRA, "device_screen_height", "device_screen_width"),
    ]


def _cs_full_geo() -> list[Column]:
    missing = ("geo_continent", "geo_sub_continent", "geo_zipcode", "geo_latitude", "geo_longitude", "geo_timezone")
    return [*_cs_geo(), F.col("region").alias("geo_region_name"), *_unknown(schemas.GEO, *missing)]


def stage_cs_session(sessions: DataFrame) -> DataFrame:
    """STG-11: sessions arrive aggregated; end time, numbers out of text, scores."""
    seconds = whole("session_duration")
    views = whole("session_number_of_views")
    return sessions.select(
        F.to_date("time").alias("event_date"),
        F.col("user_id").cast("string").alias("user_fk"),
        F.col("session_id").cast("string").alias("ga_session_id"),
        F.col("time").alias("session_start_ts"),
        F.timestamp_add("SECOND", seconds, F.col("time")).alias("session_end_ts"),
        seconds.alias("session_duration_seconds"),
        views.alias("page_views_per_session"),
        views.alias("events_per_session"),
        F.lit(0).cast("bigint").alias("is_conversion_session"),
        *_cs_utm(),
        *_renamed({
            "device_operating_system": "platform",
            "device_browser": "browser",
            "device_language": "session_language",
            "browser_family": "browser",
            "browser_name": "browser",
        }),
        "device_type",
        mobile_flag().alias("device_is_mobile"),
        *_cs_geo(),
        F.col("region").alias("geo_region_name"),
        *[whole(score).alias(score) for score in schemas.SESSION_SCORES],
    )


def stage_cs_pageview(pageviews: DataFrame) -> DataFrame:
    """STG-3: page views with their text measures as numbers."""
    numbers = {"bigint": whole, "double": real}
    return pageviews.select(
        *_cs_head(),
        F.lit("page_view").alias("event_name"),
        *_cs_page("path", "query", "hash", "title"),
        F.col("view_number").cast("bigint").alias("view_number"),
        text_flag("is_first").alias("is_first_view"),
        text_flag("is_last").alias("is_last_view"),
        *[numbers[kind](name).alias(name) for name, kind in schemas.WEB_VITALS.items()],
        *_cs_utm(),
        "utm_campaign",
        *_cs_full_device(browser=True),
        *_cs_full_geo(),
        "referrer", "landing_page", "session_replay_link",
    )


def stage_cs_add_to_cart(carts: DataFrame) -> DataFrame:
    """STG-4: add-to-cart clicks, without items."""
    return carts.select(
        *_cs_head(),
        _cs_pageview_id(),
        F.lit("add_to_cart").alias("event_name"),
        *_cs_page("path", "query", "hash", "title"),
        "domain", "href", "target_text",
        *_cs_utm(),
        "utm_campaign",
        *_cs_full_device(browser=True),
        *_cs_full_geo(),
        F.col("type").alias("event_type"),
        "referrer", "landing_page", "landing_page_query", "landing_page_hash",
    )


def stage_cs_purchase(transactions: DataFrame) -> DataFrame:
    """STG-5: transactions; the event id serves as transaction id."""
    return transactions.select(
        *_cs_head(),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.lit("purchase").alias("event_name"),
        "transaction_amount", "transaction_currency",
        *_unknown(schemas.TRAFFIC, *schemas.TRAFFIC),
        *_cs_full_device(browser=False),
        *_cs_full_geo(),
        F.col("type").alias("event_type"),
        "referrer",
    )


def _cs_signal(table: DataFrame, event_name: str, details: list[str | Column]) -> DataFrame:
    """The frame shared by the friction events: ids, details, device, place."""
    return table.select(
        *_cs_head(),
        _cs_pageview_id(),
        F.lit(event_name).alias("event_name"),
        F.col("type").alias("event_type"),
        *details,
        "landing_page", "referrer",
        *_cs_device(),
        *_cs_geo(),
        "library",
    )


def _cs_target(measure: str) -> list[str | Column]:
    return [
        "domain",
        *_cs_page("path", "query", "hash"),
        "target_text", "target_path", "frustration_score", "relative_time",
        F.col("value").alias(measure),
    ]


def stage_cs_rage_click(clicks: DataFrame) -> DataFrame:
    """STG-6: rage clicks; ``value`` is the number of clicks."""
    return _cs_signal(clicks, "rage_click", [
        *_cs_target("click_count"),
        *_unknown(schemas.TRAFFIC, "traffic_source_source", "traffic_source_medium"),
    ])


def stage_cs_excessive_hovering(hovers: DataFrame) -> DataFrame:
    """STG-7: hovering; ``value`` is its duration."""
    return _cs_signal(hovers, "excessive_hovering", _cs_target("hover_duration"))


def stage_cs_js_error(errors: DataFrame) -> DataFrame:
    """STG-8: script errors with message and position."""
    return _cs_signal(errors, "js_error", [
        "error_message", "error_line_number",
        F.col("js_error_file_name").alias("error_file_name"),
        F.col("js_error_column_number").alias("error_column_number"),
        "errors_after_clicks", "error_group_id", "error_source",
    ])


def stage_cs_api_error(errors: DataFrame) -> DataFrame:
    """STG-9: failed calls with endpoint, method and status."""
    return _cs_signal(errors, "api_error", [
        "api_error_duration", "api_error_endpoint", "api_error_method", "api_error_status_code",
        "errors_after_clicks", "error_group_id", "error_source",
    ])


def stage_cs_signal(signals: DataFrame, event_name: str) -> DataFrame:
    """STG-10: a friction table of which only the common columns are known."""
    return signals.select(
        *_cs_head(),
        F.lit(event_name).alias("event_name"),
        F.col("type").alias("event_type"),
        *_cs_device(),
        *_cs_geo(),
        "referrer",
    )
