"""Columns that hold sums of fractions, which both engines round.

The order of a sum changes its last digits. Six places are kept, and four of
sums so large that the sixth is among those digits.
"""

from __future__ import annotations

_SESSION = ("purchase_revenue_per_session",)
_USER = (
    "total_revenue", "revenue_per_session", "average_order_value", "avg_session_duration_seconds",
    "avg_page_views_per_session", "pages_per_session", "avg_engagement_per_session",
)
ROUNDED: dict[str, tuple[str, ...]] = {
    "int_session": _SESSION,
    "session_fct": _SESSION,
    "mart_sessions": _SESSION,
    "session_fct_whole_sessions": _SESSION,
    "session_fct_with_transactions": _SESSION,
    "incremental_sessions": _SESSION,
    "stream_sessions": _SESSION,
    "user_dim": _USER,
    "mart_users": _USER,
    "slow_pages": ("avg_lcp", "avg_cls", "avg_fid"),
    "frustrated_users": ("avg_frustration",),
    "source_comparison": ("total_revenue", "revenue_per_session"),
    "loyalty_by_browser": ("avg_duration", "revenue"),
    "high_value_customers": ("total_revenue", "average_order_value"),
    "product_performance": ("revenue",),
    "kpi_sheet": ("value",),
    "left_join_totals": ("spent",),
    "left_join_items": ("sold",),
    "aggregates": ("returned_value", "avg_discount", "quantity", "thousands"),
    "top_items": ("quantity",),
    "metric_drift": ("base_value", "earlier_mean", "change"),
    "consistent_totals": ("left_total", "right_total", "difference"),
}

_LARGE = {
    ("kpi_sheet", "value"), ("metric_drift", "base_value"), ("metric_drift", "earlier_mean"),
    ("consistent_totals", "left_total"), ("consistent_totals", "right_total"), ("consistent_totals", "difference"),
    ("left_join_totals", "spent"), ("aggregates", "returned_value"), ("source_comparison", "total_revenue"),
    ("loyalty_by_browser", "revenue"),
}


def places(query: str, column: str) -> int:
    return 4 if (query, column) in _LARGE else 6
