"""The declared data tests, model by model (DQ-1..3, DQ-12).

Fixed values: which columns must be unique, must not be NULL, and which values
they may have. 142 tests in all.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.operators import quality as q

SOURCES = ("ga4", "snowplow", "contentsquare")
DEVICES = ("mobile", "desktop", "tablet")
USER_TYPES = ("Repeat Buyer", "One-Time Buyer", "Engaged Non-Buyer", "Single Visit")


@dataclass(frozen=True)
class Declared:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def checks(self) -> list[q.Check]:
        return [
            *[q.unique(c) for c in self.unique],
            *[q.not_null(c) for c in self.not_null],
            *[q.accepted_values(c, values) for c, values in self.accepted.items()],
        ]


_CS = ("event_pk", "event_date", "event_ts", "user_pseudo_id", "ga_session_id")
_ITEM_EVENT = Declared(
    not_null=("source", "event_pk", "event_date", "user_fk", "ga_session_id", "items"), accepted={"source": SOURCES}
)


def _item_fact(key: str) -> Declared:
    return Declared(unique=(key,), not_null=(key, "user_fk", "event_date", "item_id"))


def _signal_fact(key: str, detail: str) -> Declared:
    return Declared(unique=(key,), not_null=(key, "event_date", "user_fk", "ga_session_id", detail))


STAGING = {
    "stg_ga4__event": Declared(
        unique=("event_pk",),
        not_null=(
            "event_pk", "event_date", "event_ts", "user_pseudo_id", "event_name", "event_bundle_sequence_id",
            "device_category",
        ),
        accepted={"device_category": DEVICES},
    ),
    "stg_snowplow__event": Declared(unique=("event_pk",), not_null=(*_CS, "event_name")),
    "stg_contentsquare__pageview": Declared(unique=("event_pk",), not_null=(*_CS, "event_name")),
    "stg_contentsquare__add_to_cart": Declared(unique=("event_pk",), not_null=(*_CS, "event_name")),
    "stg_contentsquare__purchase": Declared(
        unique=("event_pk",), not_null=(*_CS, "event_name", "transaction_amount", "transaction_currency")
    ),
    "stg_contentsquare__rage_click": Declared(unique=("event_pk",), not_null=(*_CS, "frustration_score")),
    "stg_contentsquare__js_error": Declared(unique=("event_pk",), not_null=(*_CS, "error_message")),
}
INTEGRATION = {
    "int__session": Declared(
        not_null=("source", "event_date", "user_fk", "ga_session_id", "session_start_ts"), accepted={"source": SOURCES}
    ),
    "int__pageview": Declared(
        not_null=("source", "event_pk", "event_date", "user_fk", "ga_session_id", "pageview_ts"),
        accepted={"source": SOURCES},
    ),
    "int__add_to_cart": _ITEM_EVENT,
    "int__purchase": _ITEM_EVENT,
    "int__product_view": _ITEM_EVENT,
}
WAREHOUSE = {
    "session_fct": Declared(
        unique=("session_pk",), not_null=("session_pk", "event_date", "user_fk", "ga_session_id")
    ),
    "pageview_fct": Declared(
        unique=("pageview_pk",), not_null=("pageview_pk", "event_date", "user_fk", "ga_session_id")
    ),
    "add_to_cart_fct": _item_fact("add_to_cart_pk"),
    "purchase_fct": _item_fact("purchase_pk"),
    "product_view_fct": _item_fact("product_view_pk"),
    "conversion_funnel_fct": Declared(
        unique=("funnel_pk",), not_null=("funnel_pk", "event_date", "device_category"),
        accepted={"device_category": DEVICES},
    ),
    "user_dim": Declared(
        unique=("user_pk",),
        not_null=("user_pk", "total_sessions", "first_seen_date", "last_seen_date", "user_type"),
        accepted={"user_type": USER_TYPES},
    ),
    "rage_click_fct": _signal_fact("rage_click_pk", "frustration_score"),
    "js_error_fct": _signal_fact("js_error_pk", "error_message"),
    "user_interaction_fct": _signal_fact("interaction_pk", "event_name"),
}
DECLARED = {**STAGING, **INTEGRATION, **WAREHOUSE}


def declared_checks(model: str) -> list[q.Check]:
    return DECLARED[model].checks()


def tested_columns(model: str) -> list[str]:
    """The columns its declared tests read."""
    declared = DECLARED[model]
    return list(dict.fromkeys((*declared.unique, *declared.not_null, *declared.accepted)))


def test_model(model: str, df: DataFrame) -> DataFrame:
    return q.run_checks(model, df, declared_checks(model))


test_model.__test__ = False


# ------------------------------------------------------------ logical checks
_NOT_NEGATIVE = {
    "session_fct": (
        "session_duration_seconds", "page_views_per_session", "events_per_session", "purchase_events_per_session",
        "purchase_revenue_per_session",
    ),
    "pageview_fct": ("time_on_page_seconds", "engagement_time_msec", "page_number_in_session"),
    "purchase_fct": ("item_quantity", "item_price", "item_revenue_usd"),
    "add_to_cart_fct": ("item_quantity", "item_price"),
    "user_dim": ("total_revenue", "user_lifetime_days"),
}


def _falling(columns: list[str]) -> Column:
    pairs = zip(columns, columns[1:], strict=False)
    return reduce(lambda a, b: a & b, [F.col(a) >= F.col(b) for a, b in pairs])


def logical_checks(model: str) -> list[q.Check]:
    """DQ-12: no negative measures; known oddities of the data only warn."""
    checks = [
        q.expression_is_true(f"{name} >= 0", F.col(name) >= 0) for name in _NOT_NEGATIVE.get(model, ())
    ]
    if model == "purchase_fct":
        checks.append(q.not_null("transaction_id", severity=q.WARN))
    if model == "conversion_funnel_fct":
        steps = [f"sessions_with_{s}" for s in ("pageview", "product_view", "add_to_cart", "begin_checkout", "purchase")]
        checks.append(q.expression_is_true("stages fall", _falling(steps), severity=q.WARN))
    return checks
