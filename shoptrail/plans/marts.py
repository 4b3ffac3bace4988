"""Mart views: the facts under analysts' names (MRT-1..7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

# View name, fact it shows, renamed columns.
MARTS = {
    "sessions": ("session_fct", {"user_fk": "user_pseudo_id"}),
    "pageviews": ("pageview_fct", {"user_fk": "user_pseudo_id"}),
    "users": ("user_dim", {"user_pk": "user_pseudo_id"}),
    "add_to_cart_events": ("add_to_cart_fct", {"user_fk": "user_pseudo_id"}),
    "purchase_events": ("purchase_fct", {"user_fk": "user_pseudo_id"}),
    "product_views": ("product_view_fct", {"user_fk": "user_pseudo_id"}),
    "conversion_funnel": ("conversion_funnel_fct", {}),
}


def mart(name: str, fact: DataFrame) -> DataFrame:
    return fact.withColumnsRenamed(MARTS[name][1])


def register_marts(facts: dict[str, DataFrame]) -> list[str]:
    """Make a view of every fact given; returns the views' names."""
    made = []
    for name, (fact, _) in MARTS.items():
        if fact in facts:
            mart(name, facts[fact]).createOrReplaceTempView(name)
            made.append(name)
    return made
