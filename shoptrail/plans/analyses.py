"""Published analyses over the facts (ANA-1..11)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.config import CONTENTSQUARE, SNOWPLOW
from shoptrail.functions.numbers import ratio


def sessions_by_device(sessions: DataFrame) -> DataFrame:
    """ANA-1: sessions whose device kind is known, by source, device and place."""
    by = ["source", "device_category", "browser_family", "device_is_mobile", "geo_zipcode"]
    return (
        sessions.filter(F.col("device_is_mobile").isNotNull())
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("sessions"))
        .orderBy(F.desc("sessions"), *by)
    )


def slow_pages(pageviews: DataFrame, worse_than: float = 2500) -> DataFrame:
    """ANA-2: pages whose largest paint takes too long on average."""
    return (
        pageviews.filter((F.col("source") == CONTENTSQUARE) & F.col("largest_contentful_paint").isNotNull())
        .groupBy("page_path")
        .agg(
            F.avg("largest_contentful_paint").alias("avg_lcp"),
            F.avg("cumulative_layout_shift").alias("avg_cls"),
            F.avg("first_input_delay").alias("avg_fid"),
            F.count(F.lit(1)).alias("pageviews"),
        )
        .filter(F.col("avg_lcp") > worse_than)
        .orderBy(F.desc("avg_lcp"), "page_path")
    )


def frustrated_users(rage_clicks: DataFrame, more_than: int = 5) -> DataFrame:
    """ANA-3: users with many rage clicks.

    Clicks are summed per user and session first; the sessions are then
    counted without a distinct aggregate.
    """
    per_session = rage_clicks.groupBy("user_fk", "ga_session_id").agg(
        F.sum("frustration_score").alias("score"),
        F.count("frustration_score").alias("scored"),
        F.count(F.lit(1)).alias("clicks"),
    )
    return (
        per_session.groupBy("user_fk")
        .agg(
            F.count("ga_session_id").alias("sessions_with_rage"),
            ratio(F.sum("score"), F.sum("scored")).alias("avg_frustration"),
            F.sum("clicks").alias("rage_click_events"),
        )
        .filter(F.col("rage_click_events") > more_than)
        .orderBy(F.desc("avg_frustration"), "user_fk")
    )


def friction_by_score(sessions: DataFrame, js_errors: DataFrame, rage_clicks: DataFrame) -> DataFrame:
    """ANA-4: distinct script errors and rage clicks per frustration score.

    Joining both event tables to sessions directly pairs every error of a
    session with every click of it. An event belongs to one session id, so each
    table is first counted per session id; one row per session meets the
    (score, session) pairs, and the counts are added up per score.
    """
    scored = (
        sessions.filter(F.col("source") == CONTENTSQUARE)
        .select("frustration_score", "ga_session_id")
        .distinct()
    )

    def counted(events: DataFrame, key: str, name: str) -> DataFrame:
        once = events.filter(F.col(key).isNotNull()).select("ga_session_id", key).distinct()
        return once.groupBy("ga_session_id").agg(F.count(F.lit(1)).alias(name))

    joined = scored.join(counted(js_errors, "js_error_pk", "js_errors"), "ga_session_id", "left")
    joined = joined.join(counted(rage_clicks, "rage_click_pk", "rage_clicks"), "ga_session_id", "left")
    return (
        joined.groupBy("frustration_score")
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("js_errors", "rage_clicks")])
        .orderBy("frustration_score")
    )


def source_comparison(sessions: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """ANA-5: the sources side by side, per day."""
    per_user = (
        sessions.filter(F.col("event_date").between(F.lit(start), F.lit(end)))
        .groupBy("event_date", "source", "user_fk")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("page_views_per_session").alias("views"),
            F.sum("purchase_events_per_session").alias("purchases"),
            F.sum("purchase_revenue_per_session").alias("revenue"),
        )
    )
    return (
        per_user.groupBy("event_date", "source")
        .agg(
            F.count("user_fk").alias("unique_users"),
            F.sum("sessions").alias("total_sessions"),
            F.sum("views").alias("total_pageviews"),
            F.sum("purchases").alias("total_purchases"),
            F.sum("revenue").alias("total_revenue"),
        )
        .withColumn("revenue_per_session", ratio("total_revenue", "total_sessions"))
        .orderBy("event_date", "source")
    )


def loyalty_by_browser(sessions: DataFrame, since: dt.date) -> DataFrame:
    """ANA-6: Snowplow's browser family and loyalty tier."""
    by = ["browser_family", "user_loyalty_tier"]
    chosen = sessions.filter(
        (F.col("source") == SNOWPLOW) & (F.col("event_date") >= F.lit(since)) & F.col("user_loyalty_tier").isNotNull()
    )
    per_user = chosen.groupBy(*by, "user_fk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("session_duration_seconds").alias("seconds"),
        F.count("session_duration_seconds").alias("timed"),
        F.sum("purchase_revenue_per_session").alias("spent"),
    )
    return (
        per_user.groupBy(*by)
        .agg(
            F.sum("n").alias("sessions"),
            ratio(F.sum("seconds"), F.sum("timed")).alias("avg_duration"),
            F.sum("spent").alias("revenue"),
            F.count("user_fk").alias("unique_users"),
        )
        .orderBy(F.desc("revenue"), *by)
    )


def top_converting_sources(funnel: DataFrame, day: dt.date, k: int = 10) -> DataFrame:
    """ANA-7."""
    return (
        funnel.filter(F.col("event_date") == F.lit(day))
        .orderBy(F.desc("sessions_with_purchase"), "funnel_pk")
        .limit(k)
        .select(
            "traffic_source_full", "total_sessions", "sessions_with_purchase",
            "session_overall_conversion_rate", "users_with_purchase",
        )
    )


def high_value_customers(users: DataFrame, k: int = 100) -> DataFrame:
    """ANA-8, over the ``users`` mart."""
    return (
        users.filter(F.col("total_revenue") > 0)
        .orderBy(F.desc("total_revenue"), "user_pseudo_id")
        .limit(k)
        .select(
            "user_pseudo_id", "total_revenue", "total_purchases", "average_order_value",
            "user_type", "monetary_segment", "recency_segment",
        )
    )


def product_performance(
    product_views: DataFrame, carts: DataFrame, purchases: DataFrame, k: int = 20
) -> DataFrame:
    """ANA-9: each table is reduced to one row per item, and the views to the top ones, before the joins."""
    seen = product_views.groupBy("item_id", "item_name").agg(F.count(F.lit(1)).alias("views"))
    seen = seen.orderBy(F.desc("views"), "item_id", "item_name").limit(k)
    carted = carts.groupBy("item_id").agg(F.count(F.lit(1)).alias("add_to_carts"))
    bought = purchases.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("item_revenue_usd").alias("revenue")
    )
    zero = F.lit(0)
    return (
        seen.join(carted, "item_id", "left")
        .join(bought, "item_id", "left")
        .orderBy(F.desc("views"), "item_id", "item_name")
        .select(
            "item_name",
            "views",
            F.coalesce("add_to_carts", zero).alias("add_to_carts"),
            F.coalesce("purchases", zero).alias("purchases"),
            F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
            ratio(F.coalesce("purchases", zero), "views").alias("view_to_purchase_rate"),
        )
    )


def volume_by_source(facts: dict[str, DataFrame]) -> DataFrame:
    """ANA-10: rows per fact and source, with a total per fact."""
    counted = [df.groupBy("source").agg(F.count(F.lit(1)).alias("rows")).withColumn("metric", F.lit(name)) for name, df in facts.items()]
    return (
        reduce(DataFrame.unionByName, counted)
        .rollup("metric", "source")
        .agg(F.sum("rows").alias("row_count"), F.grouping("metric").alias("all_facts"), F.grouping("source").alias("total"))
        .filter(F.col("all_facts") == 0)
        .select("metric", F.when(F.col("total") == 1, "total").otherwise(F.col("source")).alias("source"), "row_count")
        .orderBy("metric", "source")
    )


def kpi_sheet(sessions: DataFrame, pageviews: DataFrame, purchases: DataFrame, users: DataFrame) -> DataFrame:
    """ANA-11: one (metric, value) row per key figure.

    Bounce rate: sessions of one page view among sessions with a page view.
    Average order value: revenue per purchase event.
    """
    def long(figures: DataFrame) -> DataFrame:
        """One row of figures to one row per figure."""
        names = figures.columns
        pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
        return figures.select(F.explode(F.array(*pairs)).alias("kpi")).select("kpi.*")

    converted = F.count_if(F.col("is_conversion_session") == 1)
    revenue = F.sum("purchase_revenue_per_session")
    n = F.count(F.lit(1))
    from_sessions = sessions.agg(
        n.alias("sessions"),
        F.sum("page_views_per_session").alias("page_views"),
        ratio(F.sum("page_views_per_session"), n).alias("pages_per_session"),
        ratio(converted, n).alias("conversion_rate"),
        revenue.alias("revenue"),
        ratio(revenue, F.sum("purchase_events_per_session")).alias("average_order_value"),
        ratio(revenue, n).alias("revenue_per_session"),
    )
    first_views = F.count_if(F.col("page_number_in_session") == 1)
    single = F.count_if(F.col("total_pages_in_session") == 1)
    from_views = pageviews.agg(ratio(single, first_views).alias("bounce_rate"))
    from_items = purchases.agg(n.alias("purchase_items"))
    buyers = F.count_if(F.col("total_purchases") > 0)
    repeat = F.count_if(F.col("total_purchases") > 1)
    from_users = users.agg(
        n.alias("users"),
        buyers.alias("buyers"),
        ratio(buyers, n).alias("buyer_share"),
        repeat.alias("repeat_buyers"),
        ratio(repeat, buyers).alias("repeat_buyer_share"),
    )
    recency = users.groupBy("recency_segment").agg(n.cast("double").alias("value")).select(
        F.concat(F.lit("users: "), F.col("recency_segment")).alias("metric"), "value"
    )
    parts = [long(from_sessions), long(from_views), long(from_items), long(from_users), recency]
    return reduce(DataFrame.unionByName, parts)
