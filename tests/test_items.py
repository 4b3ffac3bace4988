from __future__ import annotations

import pytest

from shoptrail import schemas
from shoptrail.plans import facts, integration, staging
from tests.feeds import cs_frame, ga4, ga4_frame, snowplow, snowplow_frame


def staged(spark, rows):
    return staging.stage_ga4_event(ga4_frame(spark, rows))


def test_one_row_per_item_with_its_position(spark):
    events = staged(spark, [
        ga4("u", "2024-01-01 10:00:00", "add_to_cart", 1, 0, items=[
            {"item_id": "a", "price": 2.0, "quantity": 3}, {"item_id": "a", "price": 2.0}]),
        ga4("u", "2024-01-01 10:00:01", "add_to_cart", 1, 1, items=[]),
        ga4("u", "2024-01-01 10:00:02", "add_to_cart", 1, 2),
        ga4("u", "2024-01-01 10:00:03", "view_item", 1, 3, items=[{"item_id": "b"}]),
    ])
    unified = integration.unify_add_to_cart(spark, events)
    assert [r.n for r in unified.selectExpr("size(items) n").collect()] == [2, 0, 0]
    rows = facts.add_to_cart_fct(unified).collect()
    assert sorted((r.item_id, r.item_value) for r in rows if r.item_value is not None) == [("a", 6.0)]
    assert len({r.add_to_cart_pk for r in rows}) == len(rows) == 2


def test_categories_are_cleaned(spark):
    events = staged(spark, [ga4("u", "2024-01-01 10:00:00", "view_item", 1, items=[
        {"item_id": "a", "item_category": None, "item_category2": "(not set)", "item_category3": "Shoes"},
        {"item_id": "b", "item_category": "(not set)", "item_category5": "(not set)"},
    ])])
    rows = facts.product_view_fct(integration.unify_product_views(spark, events)).orderBy("item_id").collect()
    levels = [tuple(r[f"category_l{n}"] for n in range(1, 6)) for r in rows]
    assert levels == [("Uncategorized", None, "Shoes", None, None), ("(not set)", None, None, None, None)]


def test_cart_keeps_raw_categories(spark):
    events = staged(spark, [ga4("u", "2024-01-01 10:00:00", "add_to_cart", 1, items=[{"item_id": "a", "item_category2": "(not set)"}])])
    row = facts.add_to_cart_fct(integration.unify_add_to_cart(spark, events)).first()
    assert (row.item_category, row.item_category2) == (None, "(not set)")


FULL = {n: ("t" if k == "string" else 2) for n, k in schemas.GA4_ITEM_FIELDS.items()}


@pytest.mark.parametrize(("event", "unify", "absent"), [
    ("add_to_cart", integration.unify_add_to_cart, set()),
    ("purchase", integration.unify_purchases, {"creative_name", "creative_slot"}),
    ("view_item", integration.unify_product_views,
     {"price_in_usd", "quantity", "item_revenue", "item_revenue_in_usd", "affiliation", "coupon"}),
])
def test_ga4_item_fields_per_event(spark, event, unify, absent):
    events = staged(spark, [ga4("u", "2024-01-01 10:00:00", event, 1, items=[FULL])])
    item = unify(spark, events).first()["items"][0].asDict()
    assert list(item) == list(schemas.ITEM_FIELDS)
    assert {n for n, v in item.items() if v is None} == absent | {"discount", "index"}


def test_snowplow_item_fields(spark):
    item = {n: ("t" if k == "string" else 2) for n, k in schemas.SNOWPLOW_ITEM_FIELDS.items()}
    events = staging.stage_snowplow_event(snowplow_frame(spark, [
        snowplow("e", "u", "2024-01-01 10:00:00", "purchase", "1", ecommerce={
            "value": 10.0, "tax": 1.0, "shipping": 2.0, "currency": "EUR", "transaction_id": "T", "items": [item]}),
    ]))
    row = integration.unify_purchases(spark, snowplow=events).first()
    known = {n for n, v in row["items"][0].asDict().items() if v is not None}
    assert known == set(schemas.SNOWPLOW_ITEM_FIELDS) | {"item_list_index"}
    assert (row.purchase_revenue, row.purchase_revenue_in_usd, row.tax_value_in_usd, row.ecommerce_value) == (10.0, None, 1.0, 10.0)


def test_purchase_timing_over_all_sources(spark):
    events = staged(spark, [
        ga4("u", "2024-01-07 10:00:00", "purchase", 1, items=[{"item_id": "a", "item_revenue_in_usd": 9.0, "quantity": 3}]),
        ga4("w", "2024-01-07 10:00:00", "purchase", None, 1, items=[{"item_id": "a", "quantity": 0, "item_revenue_in_usd": 1.0}]),
    ])
    earlier = staging.stage_cs_session(cs_frame(spark, "sessions", [
        {"time": "2024-01-05 10:30:00", "user_id": "u", "session_id": "9"}]))
    sessions = facts.session_fct(integration.unify_sessions(spark, events, contentsquare=earlier))
    rows = {r.user_fk: r for r in facts.purchase_fct(integration.unify_purchases(spark, events), sessions).collect()}
    u, w = rows["u"], rows["w"]
    assert (u.hours_to_purchase_from_first_visit, u.days_to_purchase_from_first_visit) == (47, 1)
    assert (u.purchase_hour_of_day, u.purchase_day_of_week, u.unit_price_usd) == (10, 1, 3.0)
    assert (w.hours_to_purchase_from_first_visit, w.unit_price_usd) == (None, None)
