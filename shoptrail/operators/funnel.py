"""Conversion funnel: distinct sessions and users per stage (AGG-8, AGG-13, PHY-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.keys import surrogate_key
from shoptrail.functions.numbers import ratio
from shoptrail.functions.text import source_medium

# Event name and column suffix of each stage, in order.
STAGES = (
    ("page_view", "pageview"),
    ("view_item", "product_view"),
    ("add_to_cart", "add_to_cart"),
    ("begin_checkout", "begin_checkout"),
    ("purchase", "purchase"),
)
SEGMENT = ("event_date", "traffic_source_source", "traffic_source_medium", "device_category", "geo_country")


def stage_counts(
    events: DataFrame,
    segment: Sequence[str] = SEGMENT,
    session_key: Sequence[str] = ("ga_session_id",),
    strict_order: bool = False,
) -> DataFrame:
    """Distinct sessions and users per segment, in total and per stage.

    Twelve ``count(distinct ...)`` would make Spark copy every event twelve
    times and shuffle the copies. Here each event stands for its session and
    for its user, the stages it reached are bits of one number, and both steps
    are aggregates that are combined before their shuffle: first the bits per
    (segment, session or user), then counts per segment.

    ``strict_order`` counts a stage only where all earlier ones were reached.
    A segment whose events all lack a session id is kept, with 0 sessions.
    """
    names = [event for event, _ in STAGES]
    bit = F.lit(0)
    for position, name in enumerate(names):
        bit = F.when(F.col("event_name") == name, F.lit(1 << position)).otherwise(bit)
    known = F.lit(True)
    for column in session_key:
        known = known & F.col(column).isNotNull()
    session = F.when(known, F.concat_ws("\u0001", *[F.col(c).cast("string") for c in session_key]))
    who = F.explode(F.array(
        F.struct(F.lit("sessions").alias("kind"), session.alias("id")),
        F.struct(F.lit("users").alias("kind"), F.col("user_pseudo_id").cast("string").alias("id")),
    ))
    reached = (
        events.filter(F.col("event_name").isin(names))
        .select(*segment, bit.alias("bit"), who.alias("who"))
        .groupBy(*segment, "who.kind", "who.id")
        .agg(F.bit_or("bit").alias("stages"))
        .filter(F.col("id").isNotNull() | (F.col("kind") == "sessions"))
    )
    counts = []
    for kind in ("sessions", "users"):
        one = (F.col("kind") == kind) & F.col("id").isNotNull()
        counts.append(F.count_if(one).alias(f"total_{kind}"))
        for position, (_, suffix) in enumerate(STAGES):
            wanted = (1 << (position + 1)) - 1 if strict_order else 1 << position
            hit = F.col("stages").bitwiseAND(F.lit(wanted)) == wanted
            counts.append(F.count_if(one & hit).alias(f"{kind}_with_{suffix}"))
    return reached.groupBy(*segment).agg(*counts)


def _rates(kind: str) -> list[Column]:
    """Step rates and the overall rate of ``sessions`` or ``users``."""
    one = kind.rstrip("s")
    steps = (
        ("pageview", "product_view", "pv_to_product_view"),
        ("product_view", "add_to_cart", "product_view_to_cart"),
        ("add_to_cart", "begin_checkout", "cart_to_checkout"),
        ("begin_checkout", "purchase", "checkout_to_purchase"),
    )
    rates = [ratio(f"{kind}_with_{to}", f"{kind}_with_{frm}").alias(f"{one}_{name}_rate") for frm, to, name in steps]
    rates.append(ratio(f"{kind}_with_purchase", f"total_{kind}").alias(f"{one}_overall_conversion_rate"))
    return rates


def _drop_offs() -> tuple[list[Column], list[Column]]:
    steps = (
        ("pageview", "product_view", "product_view"),
        ("product_view", "add_to_cart", "cart"),
        ("add_to_cart", "begin_checkout", "checkout"),
        ("begin_checkout", "purchase", "purchase"),
    )
    lost = {at: F.col(f"sessions_with_{frm}") - F.col(f"sessions_with_{to}") for frm, to, at in steps}
    return (
        [lost[at].alias(f"sessions_dropped_at_{at}") for _, _, at in steps],
        [ratio(lost[at], f"sessions_with_{frm}").alias(f"session_dropoff_rate_at_{at}") for frm, _, at in steps],
    )


def conversion_funnel(
    events: DataFrame,
    session_key: Sequence[str] = ("ga_session_id",),
    strict_order: bool = False,
) -> DataFrame:
    """FCT-7: one row per day, traffic source, device and country."""
    def counts(kind: str) -> list[str]:
        return [f"total_{kind}", *[f"{kind}_with_{suffix}" for _, suffix in STAGES]]

    dropped, drop_rates = _drop_offs()
    return stage_counts(events, SEGMENT, session_key, strict_order).select(
        surrogate_key(*SEGMENT).alias("funnel_pk"),
        "event_date", "traffic_source_source", "traffic_source_medium",
        source_medium().alias("traffic_source_full"),
        "device_category", "geo_country",
        *counts("sessions"), *_rates("sessions"),
        *counts("users"), *_rates("users"),
        *dropped, *drop_rates,
    )
