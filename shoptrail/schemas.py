"""Column names and types of the raw feeds and of the unified rows.

Fixed values throughout: these are the published names and types of the data
model, in their published order.
"""

from __future__ import annotations

# ---------------------------------------------------------------- item struct
ITEM_FIELDS = {
    "item_id": "string",
    "item_name": "string",
    "item_brand": "string",
    "item_variant": "string",
    "item_category": "string",
    "item_category2": "string",
    "item_category3": "string",
    "item_category4": "string",
    "item_category5": "string",
    "price": "double",
    "price_in_usd": "double",
    "quantity": "bigint",
    "item_revenue": "double",
    "item_revenue_in_usd": "double",
    "affiliation": "string",
    "coupon": "string",
    "item_list_id": "string",
    "item_list_name": "string",
    "item_list_index": "string",
    "promotion_id": "string",
    "promotion_name": "string",
    "creative_name": "string",
    "creative_slot": "string",
    "discount": "double",
    "index": "string",
}
GA4_ITEM_FIELDS = {n: t for n, t in ITEM_FIELDS.items() if n not in ("discount", "index")}
SNOWPLOW_ITEM_FIELDS = {
    n: ITEM_FIELDS[n]
    for n in (
        "item_id", "item_name", "item_brand", "item_variant", "item_category", "item_category2",
        "price", "quantity", "affiliation", "coupon", "item_list_id", "item_list_name", "index", "discount",
    )
}


def _struct(fields: dict[str, str]) -> str:
    return "struct<" + ", ".join(f"`{n}`: {t}" for n, t in fields.items()) + ">"


def _texts(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields.items())


ITEM_ARRAY = f"array<{_struct(ITEM_FIELDS)}>"

# ------------------------------------------------------------------ raw feeds
GA4_EVENTS = {
    "event_date": "string",
    "event_timestamp": "bigint",
    "event_name": "string",
    "event_bundle_sequence_id": "bigint",
    "user_pseudo_id": "string",
    "event_params": "array<struct<key: string, value: struct<string_value: string, int_value: bigint>>>",
    "ecommerce": _struct({
        "transaction_id": "string",
        "purchase_revenue_in_usd": "double",
        "purchase_revenue": "double",
        "tax_value_in_usd": "double",
        "shipping_value_in_usd": "double",
        "total_item_quantity": "bigint",
        "unique_items": "bigint",
    }),
    "items": f"array<{_struct(GA4_ITEM_FIELDS)}>",
    "traffic_source": _struct(_texts("name", "medium", "source")),
    "device": "struct<category: string, operating_system: string, language: string, web_info: struct<browser: string>>",
    "geo": _struct(_texts("continent", "sub_continent", "country", "region", "city")),
}

SNOWPLOW_EVENTS = {
    **_texts("event_id", "user_pseudo_id", "user_id", "domain_userid", "network_userid", "session_id"),
    "collector_tstamp": "timestamp",
    "dvce_created_tstamp": "timestamp",
    "etl_tstamp": "timestamp",
    **_texts("event_name", "app_id", "platform"),
    "debug_mode": "boolean",
    "ecommerce": _struct({
        "transaction_id": "string",
        "value": "double",
        "tax": "double",
        "shipping": "double",
        "currency": "string",
        "items": f"array<{_struct(SNOWPLOW_ITEM_FIELDS)}>",
    }),
    "traffic_source": _struct(_texts("source", "medium", "campaign", "content", "term")),
    "device": _struct(_texts("category", "os", "browser")),
    **_texts("br_lang", "br_family", "br_name"),
    "br_version": "double",
    **_texts("br_type", "br_renderengine", "br_colordepth"),
    "br_viewheight": "bigint",
    "br_viewwidth": "bigint",
    "br_cookies": "boolean",
    "br_features_pdf": "boolean",
    "br_features_quicktime": "boolean",
    "dvce_type": "string",
    "dvce_ismobile": "boolean",
    "dvce_screenheight": "bigint",
    "dvce_screenwidth": "bigint",
    **_texts("os_name", "os_family", "os_manufacturer", "os_timezone"),
    "geo": _struct({
        **_texts("country", "region", "region_name", "city", "zipcode", "timezone"),
        "latitude": "double",
        "longitude": "double",
    }),
    **_texts("page_location", "page_url", "page_title", "page_referrer"),
    **_texts("page_urlhost", "page_urlpath", "page_urlquery", "page_urlfragment"),
    "engagement_time_msec": "bigint",
    "user_properties": _struct(_texts("customer_segment", "loyalty_tier", "subscription_status")),
    "domain_sessionidx": "bigint",
    "user_ipaddress": "string",
    "ga4_adapter": _struct(_texts("source", "original_event_name", "data_layer_version")),
    **_texts("v_tracker", "v_collector", "v_etl"),
}

_CS_EVENT = {
    **_texts("event_id", "user_id", "session_id"),
    "time": "timestamp",
    **_texts("type", "platform", "device_type", "country", "region", "city", "referrer"),
}
_CS_UTM = _texts("utm_medium", "utm_source", "utm_content", "utm_term", "utm_campaign")
_CS_PAGE = _texts("path", "query", "hash", "title")
_CS_TARGET = {
    **_texts("pageview_id", "domain", "path", "query", "hash", "landing_page", "target_text", "target_path"),
    "frustration_score": "bigint",
    "relative_time": "bigint",
    "value": "bigint",
    "library": "string",
}

CONTENTSQUARE_TABLES = {
    "sessions": {
        "time": "timestamp",
        **_texts(
            "user_id", "session_id", "session_duration", "session_number_of_views", "frustration_score",
            "looping_index", "page_consumption", "utm_medium", "utm_source", "utm_content", "utm_term",
            "platform", "browser", "session_language", "device_type", "country", "region", "city",
        ),
    },
    "pageviews": {
        **_CS_EVENT, **_CS_PAGE,
        **_texts(
            "view_number", "is_first", "is_last", "scroll_rate", "view_duration_msec", "first_input_delay",
            "interaction_to_next_paint", "time_to_first_byte", "largest_contentful_paint",
            "cumulative_layout_shift", "dom_interactive_after_msec", "fully_loaded", "first_contentful_paint",
            "start_render", "window_height", "window_width",
        ),
        **_CS_UTM,
        **_texts("browser", "landing_page", "session_replay_link"),
    },
    "add_to_cart": {
        **_CS_EVENT, "pageview_id": "string", **_CS_PAGE,
        **_texts("domain", "href", "target_text"), **_CS_UTM,
        **_texts("browser", "landing_page", "landing_page_query", "landing_page_hash"),
    },
    "ecommerce_transactions": {**_CS_EVENT, "transaction_amount": "double", "transaction_currency": "string"},
    "rage_click": {**_CS_EVENT, **_CS_TARGET},
    "excessive_hovering": {**_CS_EVENT, **_CS_TARGET},
    "js_errors": {
        **_CS_EVENT,
        **_texts("pageview_id", "error_message"),
        "error_line_number": "bigint",
        "js_error_file_name": "string",
        "js_error_column_number": "bigint",
        "errors_after_clicks": "bigint",
        **_texts("error_group_id", "error_source", "landing_page", "library"),
    },
    "api_errors": {
        **_CS_EVENT,
        "pageview_id": "string",
        "api_error_duration": "bigint",
        **_texts("api_error_endpoint", "api_error_method"),
        "api_error_status_code": "bigint",
        "errors_after_clicks": "bigint",
        **_texts("error_group_id", "error_source", "landing_page", "library"),
    },
}
# Declared feeds of which only the common event columns are known.
CONTENTSQUARE_SIGNALS = (
    "custom_errors",
    "loading_time_high",
    "low_activity",
    "multiple_button_interactions",
    "multiple_field_interactions",
    "multiple_use_element",
)

# -------------------------------------------------- column groups, unified rows
TRAFFIC = _texts(
    "traffic_source_name", "traffic_source_medium", "traffic_source_source",
    "traffic_source_content", "traffic_source_term",
)
DEVICE = _texts("device_category", "device_operating_system", "device_browser", "device_language")
BROWSER = {"browser_family": "string", "browser_name": "string", "browser_version": "double"}
DEVICE_EXTRA = {
    **BROWSER,
    "device_type": "string",
    "device_is_mobile": "boolean",
    "device_screen_height": "bigint",
    "device_screen_width": "bigint",
}
GEO = {
    **_texts(
        "geo_continent", "geo_sub_continent", "geo_country", "geo_region", "geo_region_name",
        "geo_city", "geo_zipcode",
    ),
    "geo_latitude": "double",
    "geo_longitude": "double",
    "geo_timezone": "string",
}
USER_PROPERTIES = _texts("user_customer_segment", "user_loyalty_tier", "user_subscription_status")
PAGE_URL = _texts("page_url", "page_urlhost", "page_urlpath", "page_urlquery", "page_urlfragment")
WEB_VITALS = {
    "first_input_delay": "double",
    "interaction_to_next_paint": "double",
    "time_to_first_byte": "double",
    "largest_contentful_paint": "double",
    "cumulative_layout_shift": "double",
    "dom_interactive_after_msec": "bigint",
    "fully_loaded": "bigint",
    "first_contentful_paint": "double",
    "start_render": "double",
    "window_height": "bigint",
    "window_width": "bigint",
    "scroll_rate": "double",
    "view_duration_msec": "bigint",
}
SESSION_SCORES = {"frustration_score": "bigint", "looping_index": "bigint", "page_consumption": "bigint"}

# ------------------------------------------------------------ unified row types
SESSION = {
    "source": "string",
    "event_date": "date",
    "user_fk": "string",
    "ga_session_id": "string",
    "session_index": "bigint",
    "session_start_ts": "timestamp",
    "session_end_ts": "timestamp",
    "session_duration_seconds": "bigint",
    "page_views_per_session": "bigint",
    "events_per_session": "bigint",
    "session_engagement_time_msec": "bigint",
    "purchase_events_per_session": "bigint",
    "purchase_revenue_per_session": "double",
    "is_conversion_session": "bigint",
    **TRAFFIC, **DEVICE, **DEVICE_EXTRA, **GEO, **USER_PROPERTIES, **SESSION_SCORES,
}
PAGEVIEW = {
    "source": "string",
    "event_pk": "string",
    "event_date": "date",
    "pageview_ts": "timestamp",
    "user_fk": "string",
    "ga_session_id": "string",
    "page_location": "string",
    "page_title": "string",
    "page_referrer": "string",
    "entrances": "bigint",
    "engagement_time_msec": "string",
    "session_engaged": "string",
    **PAGE_URL, **TRAFFIC, **DEVICE, **BROWSER,
    "browser_viewheight": "bigint",
    "browser_viewwidth": "bigint",
    **GEO, **WEB_VITALS,
}
_ITEM_EVENT_HEAD = {
    "source": "string",
    "event_pk": "string",
    "event_date": "date",
    "event_ts": "timestamp",
    "user_fk": "string",
    "ga_session_id": "string",
}
_ITEM_EVENT_TAIL = {**TRAFFIC, **DEVICE, **DEVICE_EXTRA, **GEO, **USER_PROPERTIES}
PRODUCT_VIEW = {**_ITEM_EVENT_HEAD, "items": ITEM_ARRAY, **_ITEM_EVENT_TAIL}
ADD_TO_CART = {
    **_ITEM_EVENT_HEAD,
    "transaction_id": "string",
    "total_item_quantity": "bigint",
    "unique_items": "bigint",
    "items": ITEM_ARRAY,
    **_ITEM_EVENT_TAIL,
}
PURCHASE = {
    **_ITEM_EVENT_HEAD,
    "transaction_id": "string",
    "purchase_revenue_in_usd": "double",
    "purchase_revenue": "double",
    "tax_value_in_usd": "double",
    "shipping_value_in_usd": "double",
    "total_item_quantity": "bigint",
    "unique_items": "bigint",
    "items": ITEM_ARRAY,
    "ecommerce_value": "double",
    "ecommerce_currency": "string",
    **_ITEM_EVENT_TAIL,
}
