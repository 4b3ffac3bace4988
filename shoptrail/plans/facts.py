"""Warehouse jobs: facts, the user dimension and the funnel (FCT-1..13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail import schemas
from shoptrail.config import Options
from shoptrail.functions.keys import surrogate_key
from shoptrail.functions.numbers import ratio, whole, whole_units
from shoptrail.functions.text import category_levels, source_medium, url_host, url_path, url_query
from shoptrail.operators.flow import page_flow
from shoptrail.operators.funnel import conversion_funnel
from shoptrail.operators.items import one_row_per_item
from shoptrail.operators.users import user_dimension

DEFAULTS = Options()

FLOW_INPUT = ("next_page_ts", "previous_page_location", "page_number_in_session", "total_pages_in_session")


# ---------------------------------------------------------- sessions and pages
def session_fct(sessions: DataFrame) -> DataFrame:
    """FCT-1: the key also names the source, so equal ids of two sources stay apart."""
    return sessions.select(
        surrogate_key("source", "event_date", "user_fk", "ga_session_id").alias("session_pk"),
        "source", "user_fk", "event_date", "ga_session_id",
        *[name for name in schemas.SESSION if name not in ("source", "user_fk", "event_date", "ga_session_id")],
    )


def bare_pageviews(pageviews: DataFrame) -> DataFrame:
    """Page views with their key, without what follows from other columns of the same row."""
    return pageviews.select(
        surrogate_key("source", "event_pk").alias("pageview_pk"),
        "source", "user_fk", "event_date", "ga_session_id", "pageview_ts",
        "page_location", "page_title", "page_referrer",
        *schemas.PAGE_URL,
        F.coalesce(whole("engagement_time_msec"), F.lit(0)).alias("engagement_time_msec"),
        F.coalesce("entrances", F.lit(0)).alias("entrances"),
        F.coalesce((whole("session_engaged") == 1).cast("bigint"), F.lit(0)).alias("is_engaged_session"),
        *schemas.TRAFFIC, *schemas.DEVICE, *schemas.BROWSER,
        "browser_viewheight", "browser_viewwidth",
        *schemas.GEO, *schemas.WEB_VITALS,
    )


def with_url_parts(rows: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Bare page views with what follows from their other columns."""
    url = F.coalesce(F.col("page_location"), F.col("page_url"))
    return rows.withColumns({
        "page_path": url_path(url, options.strict_url),
        "page_hostname": url_host(url, options.strict_url),
        "query_string": url_query(url),
        "engagement_time_seconds": F.col("engagement_time_msec") / F.lit(1000.0),
        "traffic_source_full": source_medium(),
    })


def pageview_rows(pageviews: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """All of a page view that does not depend on its neighbours."""
    return with_url_parts(bare_pageviews(pageviews), options)


def with_flow(rows: DataFrame) -> DataFrame:
    """Page view rows with their place in the session, in published order."""
    return placed(page_flow(rows))


def placed(rows: DataFrame) -> DataFrame:
    """What ``page_flow`` gave, in published order: a projection."""
    number, total = F.col("page_number_in_session"), F.col("total_pages_in_session")
    return rows.select(
        "pageview_pk", "source", "user_fk", "event_date", "ga_session_id", "pageview_ts",
        "page_location", "page_title", "page_referrer", "previous_page_location",
        *schemas.PAGE_URL,
        "page_path", "page_hostname", "query_string",
        "engagement_time_msec", "engagement_time_seconds",
        whole_units("SECOND", "pageview_ts", "next_page_ts").alias("time_on_page_seconds"),
        number, total,
        (number == 1).cast("bigint").alias("is_entrance"),
        (number == total).cast("bigint").alias("is_exit"),
        "entrances", "is_engaged_session",
        *schemas.TRAFFIC, "traffic_source_full",
        *schemas.DEVICE, *schemas.BROWSER,
        "browser_viewheight", "browser_viewwidth",
        *schemas.GEO, *schemas.WEB_VITALS,
    )


def pageview_fct(pageviews: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """FCT-2."""
    return with_flow(pageview_rows(pageviews, options))


# ------------------------------------------------------------------ item facts
def _item_key(name: str) -> Column:
    return surrogate_key("source", "event_pk", "item_id", "item_offset").alias(name)


def _item_tail() -> list[str | Column]:
    return [
        *schemas.TRAFFIC, source_medium().alias("traffic_source_full"),
        *schemas.DEVICE, *schemas.DEVICE_EXTRA, *schemas.GEO, *schemas.USER_PROPERTIES,
    ]


def product_view_fct(product_views: DataFrame) -> DataFrame:
    """FCT-3: one row per viewed item."""
    return one_row_per_item(product_views).select(
        _item_key("product_view_pk"),
        "source", "user_fk", "event_date", "ga_session_id",
        F.col("event_ts").alias("product_view_ts"),
        "item_id", "item_name", "item_brand", "item_variant",
        *category_levels(),
        F.col("price").alias("item_price"),
        "item_list_id", "item_list_name", "item_list_index",
        "promotion_id", "promotion_name", "creative_name", "creative_slot",
        *_item_tail(),
    )


def add_to_cart_fct(carts: DataFrame) -> DataFrame:
    """FCT-4: one row per item put into a cart; categories as they came."""
    return one_row_per_item(carts).select(
        _item_key("add_to_cart_pk"),
        "source", "user_fk", "event_date", "ga_session_id",
        F.col("event_ts").alias("add_to_cart_ts"),
        "transaction_id", "total_item_quantity", "unique_items",
        "item_id", "item_name", "item_brand", "item_variant",
        "item_category", *[f"item_category{n}" for n in range(2, 6)],
        F.col("price").alias("item_price"),
        F.col("quantity").alias("item_quantity"),
        (F.col("price") * F.col("quantity")).alias("item_value"),
        "coupon", "item_list_id", "item_list_name", "item_list_index",
        "promotion_id", "promotion_name", "creative_name", "creative_slot",
        *_item_tail(),
    )


def first_visits(sessions: DataFrame) -> DataFrame:
    """The first session start of each user over all sources."""
    return sessions.groupBy("user_fk").agg(F.min("session_start_ts").alias("first_session_ts"))


def purchase_fct(purchases: DataFrame, sessions: DataFrame) -> DataFrame:
    """FCT-5 from the session fact table, which is reduced to one row per user first (JOI-1)."""
    return timed_purchases(purchases, first_visits(sessions))


def since_first_visit(rows: DataFrame, ts: str) -> DataFrame:
    """Hours and days from ``first_session_ts`` to the purchase."""
    return rows.withColumns({
        "hours_to_purchase_from_first_visit": whole_units("HOUR", "first_session_ts", ts),
        "days_to_purchase_from_first_visit": whole_units("DAY", "first_session_ts", ts),
    })


def timed_purchases(purchases: DataFrame, visits: DataFrame) -> DataFrame:
    """FCT-5: one row per bought item, with the time since the first visit.

    ``visits`` has one row per user. Adaptive execution splits a user with very
    many purchases if it is a written table, as in a run; an aggregate right
    before the join would keep that user in one task. The join is made per
    purchase, before the items are unnested.

    Transaction amounts repeat on every item row: add up ``item_revenue`` and
    ``item_revenue_usd``, not ``purchase_revenue``.
    """
    timed = purchases.join(visits, "user_fk", "left")
    usd, quantity = F.col("item_revenue_in_usd"), F.col("quantity")
    return since_first_visit(one_row_per_item(timed), "event_ts").select(
        _item_key("purchase_pk"),
        "source", "user_fk", "event_date", "ga_session_id", "transaction_id",
        F.col("event_ts").alias("purchase_ts"),
        "hours_to_purchase_from_first_visit", "days_to_purchase_from_first_visit",
        F.hour("event_ts").cast("bigint").alias("purchase_hour_of_day"),
        F.dayofweek("event_ts").cast("bigint").alias("purchase_day_of_week"),
        "purchase_revenue_in_usd", "purchase_revenue", "tax_value_in_usd", "shipping_value_in_usd",
        "total_item_quantity", "unique_items", "ecommerce_value", "ecommerce_currency",
        "item_id", "item_name", "item_brand", "item_variant",
        *category_levels(),
        F.col("price_in_usd").alias("item_price_usd"),
        F.col("price").alias("item_price"),
        quantity.alias("item_quantity"),
        usd.alias("item_revenue_usd"),
        "item_revenue",
        ratio(usd, quantity).alias("unit_price_usd"),
        "coupon", "affiliation", "item_list_id", "item_list_name", "promotion_id", "promotion_name",
        *_item_tail(),
    )


# ------------------------------------------------------------ users and funnel
def user_dim(sessions: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """FCT-6."""
    return user_dimension(sessions, options.as_of)


def conversion_funnel_fct(events: DataFrame) -> DataFrame:
    """FCT-7 over any staged event frame."""
    return conversion_funnel(events)


# ---------------------------------------------------------- friction facts (CS)
def _signal_head(key: str, ts: str) -> list[str | Column]:
    return [
        surrogate_key("event_pk").alias(key),
        F.col("user_pseudo_id").alias("user_fk"),
        "event_date", "ga_session_id", "pageview_id", "event_id",
        F.col("event_ts").alias(ts),
        "event_name", "event_type",
    ]


_SIGNAL_DEVICE = ("device_operating_system", "device_type", "device_is_mobile", "geo_country", "geo_region", "geo_city")
_TARGET = ("domain", "page_path", "page_query", "page_hash", "landing_page", "target_text", "target_path",
           "frustration_score", "relative_time")
_ERROR = ("errors_after_clicks", "error_group_id", "error_source", "landing_page", "referrer")


def rage_click_fct(clicks: DataFrame) -> DataFrame:
    """FCT-8."""
    return clicks.select(
        *_signal_head("rage_click_pk", "rage_click_ts"),
        *_TARGET, "click_count",
        "traffic_source_source", "traffic_source_medium",
        *_SIGNAL_DEVICE, "referrer", "library",
    )


def js_error_fct(errors: DataFrame) -> DataFrame:
    """FCT-9."""
    return errors.select(
        *_signal_head("js_error_pk", "error_ts"),
        "error_message", "error_line_number", "error_file_name", "error_column_number",
        *_ERROR, *_SIGNAL_DEVICE, "library",
    )


def user_interaction_fct(carts: DataFrame) -> DataFrame:
    """FCT-10."""
    return carts.select(
        *_signal_head("interaction_pk", "interaction_ts"),
        "page_path", "page_query", "page_hash", "page_title", "domain", "href", "target_text",
        *schemas.TRAFFIC, "utm_campaign",
        *schemas.DEVICE, "browser_name", "browser_family", "browser_version",
        "device_type", "device_is_mobile", "device_screen_height", "device_screen_width",
        *schemas.GEO,
        "referrer", "landing_page", "landing_page_query", "landing_page_hash",
    )


def cs_purchase_fct(transactions: DataFrame) -> DataFrame:
    """FCT-11: transactions, which carry no items and no page view id."""
    return transactions.select(
        surrogate_key("event_pk").alias("cs_purchase_pk"),
        F.col("user_pseudo_id").alias("user_fk"),
        "event_date", "ga_session_id", "event_id", "transaction_id",
        F.col("event_ts").alias("purchase_ts"),
        "event_name", "event_type", "transaction_amount", "transaction_currency",
        *_SIGNAL_DEVICE, "geo_region_name", "referrer",
    )


def api_error_fct(errors: DataFrame) -> DataFrame:
    """FCT-12."""
    return errors.select(
        *_signal_head("api_error_pk", "error_ts"),
        "api_error_duration", "api_error_endpoint", "api_error_method", "api_error_status_code",
        *_ERROR, *_SIGNAL_DEVICE, "library",
    )


def excessive_hovering_fct(hovers: DataFrame) -> DataFrame:
    """FCT-13."""
    return hovers.select(
        *_signal_head("excessive_hovering_pk", "hover_ts"),
        *_TARGET, "hover_duration", *_SIGNAL_DEVICE, "referrer", "library",
    )
