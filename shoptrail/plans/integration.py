"""Integration jobs: all sources in one schema (INT-1..5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas
from shoptrail.config import CONTENTSQUARE, GA4, SNOWPLOW, Options
from shoptrail.functions.params import param_long, param_number, param_text
from shoptrail.operators.columns import union_sources
from shoptrail.operators.items import normalise_items
from shoptrail.operators.sessions import sessionise

DEFAULTS = Options()

# The context columns an event source can fill; the others stay NULL.
GA4_CONTEXT = [
    "traffic_source_name", "traffic_source_medium", "traffic_source_source",
    *schemas.DEVICE,
    "geo_continent", "geo_sub_continent", "geo_country", "geo_region", "geo_city",
]
_SNOWPLOW_CONTEXT = [
    "session_index",
    *schemas.TRAFFIC, *schemas.DEVICE, *schemas.DEVICE_EXTRA,
    *[name for name in schemas.GEO if name != "geo_continent"],
    *schemas.USER_PROPERTIES,
]


def _from(source: str, frame: DataFrame) -> DataFrame:
    return frame.withColumn("source", F.lit(source))


def _unified(
    spark: SparkSession,
    fields: dict[str, str],
    options: Options,
    frames: dict[str, DataFrame | None],
) -> DataFrame:
    switched_on = options.sources.enabled()
    chosen = [_from(name, frame) for name, frame in frames.items() if frame is not None and name in switched_on]
    return union_sources(spark, chosen, fields)


# ------------------------------------------------------------------- sessions
def ga4_sessions(events: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    engagement = param_number("event_params", "engagement_time_msec", options.strict_params)
    return sessionise(
        events,
        engagement=F.coalesce(engagement, F.lit(0)),
        revenue=F.col("ecommerce.purchase_revenue_in_usd"),
        context=GA4_CONTEXT,
        grain=options.session_grain,
    )


def snowplow_sessions(events: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    return sessionise(
        events,
        engagement=F.coalesce(F.col("engagement_time_msec"), F.lit(0)),
        revenue=F.col("ecommerce.value"),
        context=_SNOWPLOW_CONTEXT,
        grain=options.session_grain,
    )


def with_transactions(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Give pre-aggregated sessions the purchases made in them.

    Purchases are summed per user and session first, so no session row is
    repeated by the join.
    """
    bought = transactions.groupBy(
        F.col("user_pseudo_id").alias("user_fk"), "ga_session_id"
    ).agg(
        F.count(F.lit(1)).alias("purchase_events_per_session"),
        F.sum("transaction_amount").alias("purchase_revenue_per_session"),
    )
    return sessions.join(bought, ["user_fk", "ga_session_id"], "left").withColumn(
        "is_conversion_session", F.col("purchase_events_per_session").isNotNull().cast("bigint")
    )


def unify_sessions(
    spark: SparkSession,
    ga4: DataFrame | None = None,
    snowplow: DataFrame | None = None,
    contentsquare: DataFrame | None = None,
    cs_transactions: DataFrame | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """INT-1: staged events (GA4, Snowplow) and staged sessions (ContentSquare)."""
    if contentsquare is not None and cs_transactions is not None and options.attach_transactions:
        contentsquare = with_transactions(contentsquare, cs_transactions)
    return _unified(spark, schemas.SESSION, options, {
        GA4: None if ga4 is None else ga4_sessions(ga4, options),
        SNOWPLOW: None if snowplow is None else snowplow_sessions(snowplow, options),
        CONTENTSQUARE: contentsquare,
    })


# ------------------------------------------------------------------ pageviews
def ga4_pageviews(events: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Page views with their parameters; views without a session id stay."""
    strict = options.strict_params
    engagement = param_text("event_params", "engagement_time_msec", strict)
    if not strict:
        sent = param_long("event_params", "engagement_time_msec")
        engagement = F.coalesce(sent.cast("string"), engagement)
    texts = ("page_location", "page_title", "page_referrer", "session_engaged")
    return events.filter(F.col("event_name") == "page_view").withColumns({
        "pageview_ts": F.col("event_ts"),
        "user_fk": F.col("user_pseudo_id"),
        "entrances": param_long("event_params", "entrances", strict),
        "engagement_time_msec": engagement,
        **{name: param_text("event_params", name, strict) for name in texts},
    })


def snowplow_pageviews(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_name") == "page_view").withColumns({
        "pageview_ts": F.col("event_ts"),
        "user_fk": F.col("user_pseudo_id"),
        "entrances": F.lit(None).cast("bigint"),
        "session_engaged": F.lit(None).cast("string"),
    })


def contentsquare_pageviews(views: DataFrame) -> DataFrame:
    location = F.concat(F.lit("https://"), F.coalesce(F.col("page_path"), F.lit("/")))
    return views.withColumns({
        "pageview_ts": F.col("event_ts"),
        "user_fk": F.col("user_pseudo_id"),
        "page_location": location,
        "page_url": location,
        "page_referrer": F.col("referrer"),
        "entrances": F.col("is_first_view").cast("bigint"),
        "engagement_time_msec": F.col("view_duration_msec").cast("string"),
        "page_urlpath": F.col("page_path"),
        "page_urlquery": F.col("page_query"),
        "page_urlfragment": F.col("page_hash"),
        "browser_viewheight": F.col("window_height"),
        "browser_viewwidth": F.col("window_width"),
    })


def unify_pageviews(
    spark: SparkSession,
    ga4: DataFrame | None = None,
    snowplow: DataFrame | None = None,
    contentsquare: DataFrame | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """INT-2."""
    return _unified(spark, schemas.PAGEVIEW, options, {
        GA4: None if ga4 is None else ga4_pageviews(ga4, options),
        SNOWPLOW: None if snowplow is None else snowplow_pageviews(snowplow),
        CONTENTSQUARE: None if contentsquare is None else contentsquare_pageviews(contentsquare),
    })


# ---------------------------------------------------------------- item events
def _item_events(events: DataFrame, source: str, event_name: str, extra: dict) -> DataFrame:
    return events.filter(F.col("event_name") == event_name).withColumns({
        "user_fk": F.col("user_pseudo_id"),
        "items": normalise_items("items", source, event_name),
        **extra,
    })


def _unify_item_events(
    spark: SparkSession,
    event_name: str,
    fields: dict[str, str],
    ga4: DataFrame | None,
    snowplow: DataFrame | None,
    ga4_extra: dict,
    snowplow_extra: dict,
    options: Options,
) -> DataFrame:
    return _unified(spark, fields, options, {
        GA4: None if ga4 is None else _item_events(ga4, GA4, event_name, ga4_extra),
        SNOWPLOW: None if snowplow is None else _item_events(snowplow, SNOWPLOW, event_name, snowplow_extra),
    })


def _part(name: str):
    return F.col(f"ecommerce.{name}")


def unify_add_to_cart(
    spark: SparkSession,
    ga4: DataFrame | None = None,
    snowplow: DataFrame | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """INT-3."""
    counts = ("transaction_id", "total_item_quantity", "unique_items")
    return _unify_item_events(
        spark, "add_to_cart", schemas.ADD_TO_CART, ga4, snowplow,
        {name: _part(name) for name in counts},
        {"transaction_id": _part("transaction_id")},
        options,
    )


def unify_purchases(
    spark: SparkSession,
    ga4: DataFrame | None = None,
    snowplow: DataFrame | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """INT-4: Snowplow's value is the revenue, its tax and shipping fill the USD columns."""
    ga4_parts = (
        "transaction_id", "purchase_revenue_in_usd", "purchase_revenue", "tax_value_in_usd",
        "shipping_value_in_usd", "total_item_quantity", "unique_items",
    )
    return _unify_item_events(
        spark, "purchase", schemas.PURCHASE, ga4, snowplow,
        {name: _part(name) for name in ga4_parts},
        {
            "transaction_id": _part("transaction_id"),
            "purchase_revenue": _part("value"),
            "tax_value_in_usd": _part("tax"),
            "shipping_value_in_usd": _part("shipping"),
            "ecommerce_value": _part("value"),
            "ecommerce_currency": _part("currency"),
        },
        options,
    )


def unify_product_views(
    spark: SparkSession,
    ga4: DataFrame | None = None,
    snowplow: DataFrame | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """INT-5."""
    return _unify_item_events(
        spark, "view_item", schemas.PRODUCT_VIEW, ga4, snowplow, {}, {}, options
    )
