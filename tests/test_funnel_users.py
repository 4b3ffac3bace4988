from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.spark_queries import rounded
from shoptrail.operators import funnel, users
from shoptrail.plans import analyses, facts, integration, staging
from tests.feeds import cs_frame, ga4, ga4_frame

NAMES = [name for name, _ in funnel.STAGES]


def event_rows(spark, rows):
    schema = ("event_date date, traffic_source_source string, traffic_source_medium string, device_category string, "
              "geo_country string, user_pseudo_id string, ga_session_id string, event_name string")
    return spark.createDataFrame(rows, schema)


def some_events(seed):
    rng = random.Random(seed)
    return [
        (dt.date(2024, 1, rng.choice([1, 2])), rng.choice(["g", None]), rng.choice(["cpc", None]), "mobile", rng.choice(["A", None]),
         rng.choice(["u1", "u2", "u3", "u3", "u3", None]), rng.choice(["1", "2", "3", None]), rng.choice([*NAMES, "scroll"]))
        for _ in range(400)
    ]


def brute_force(rows, session=lambda r: r[6], nested=False):
    """Distinct sessions and users per segment and stage, counted with sets."""
    segments = {}
    for r in rows:
        if r[7] not in NAMES:
            continue
        sets = segments.setdefault(r[:5], ({}, {}))
        for which, value in enumerate((session(r), r[5])):
            sets[which].setdefault(value, set()).add(r[7])
    result = {}
    for segment, pair in segments.items():
        counts = []
        for reached in pair:
            known = {k: v for k, v in reached.items() if k is not None}
            counts.append(len(known))
            for i, name in enumerate(NAMES):
                need = set(NAMES[: i + 1]) if nested else {name}
                counts.append(sum(need <= stages for stages in known.values()))
        result[segment] = counts
    return result


def counted(df):
    columns = [f"{p}{k}" for k in ("sessions", "users") for p in ("total_",)]
    order = []
    for kind in ("sessions", "users"):
        order += [f"total_{kind}", *[f"{kind}_with_{s}" for _, s in funnel.STAGES]]
    assert set(columns) <= set(order)
    return {tuple(r[c] for c in funnel.SEGMENT): [r[c] for c in order] for r in df.collect()}


@pytest.mark.parametrize("nested", [False, True])
def test_stage_counts_equal_sets(spark, nested):
    rows = some_events(1)
    assert counted(funnel.stage_counts(event_rows(spark, rows), strict_order=nested)) == brute_force(rows, nested=nested)


def test_sessions_of_two_users_count_once_unless_asked(spark):
    segment = (dt.date(2024, 1, 1), "g", "cpc", "mobile", "A")
    rows = [(*segment, "u", "7", "page_view"), (*segment, "v", "7", "page_view")]
    assert counted(funnel.stage_counts(event_rows(spark, rows)))[segment][0] == 1
    both = funnel.stage_counts(event_rows(spark, rows), session_key=("user_pseudo_id", "ga_session_id"))
    assert counted(both)[segment][0] == 2


def test_segment_without_sessions_stays(spark):
    segment = (dt.date(2024, 1, 1), None, None, "mobile", None)
    rows = [(*segment, "u", None, "page_view"), (*segment, None, None, "purchase")]
    row = funnel.conversion_funnel(event_rows(spark, rows)).first()
    assert (row.total_sessions, row.total_users, row.users_with_pageview, row.users_with_purchase) == (0, 1, 1, 0)
    assert (row.session_overall_conversion_rate, row.traffic_source_full) == (None, "(direct) / (none)")


def test_skipped_stage_gives_negative_drop_off(spark):
    segment = (dt.date(2024, 1, 1), "g", "cpc", "mobile", "A")
    rows = [(*segment, "u", "1", "view_item"), (*segment, "v", "2", "view_item"), (*segment, "v", "2", "page_view")]
    row = funnel.conversion_funnel(event_rows(spark, rows)).first()
    assert (row.sessions_dropped_at_product_view, row.session_pv_to_product_view_rate) == (-1, 2.0)
    strict = funnel.conversion_funnel(event_rows(spark, rows), strict_order=True).first()
    assert (strict.sessions_dropped_at_product_view, strict.session_pv_to_product_view_rate) == (0, 1.0)


@pytest.mark.parametrize(("function", "limits"), [
    (users.recency_segment, {7: "Active (Last 7 days)", 8: "Recent (Last 30 days)", 30: "Recent (Last 30 days)",
                             31: "Dormant (Last 90 days)", 90: "Dormant (Last 90 days)", 91: "Inactive (90+ days)"}),
    (users.frequency_segment, {1: "Single Session", 2: "Low Frequency (2-4 sessions)", 4: "Low Frequency (2-4 sessions)",
                               5: "Medium Frequency (5-9 sessions)", 9: "Medium Frequency (5-9 sessions)",
                               10: "High Frequency (10+ sessions)"}),
    (users.monetary_segment, {0: "No Revenue", 1: "Low Value ($1-$99)", 99: "Low Value ($1-$99)",
                              100: "Medium Value ($100-$499)", 499: "Medium Value ($100-$499)", 500: "High Value ($500+)",
                              None: "No Revenue"}),
])
def test_segment_limits(spark, function, limits):
    df = spark.createDataFrame([(v,) for v in limits], "v int")
    assert [r[0] for r in df.select(function(F.col("v"))).collect()] == list(limits.values())


def test_user_types(spark):
    df = spark.createDataFrame([(2, 1), (1, 5), (0, 2), (0, 1), (None, 3), (None, 1)], "p int, s int")
    types = [r[0] for r in df.select(users.user_type(F.col("p"), F.col("s"))).collect()]
    assert types == ["Repeat Buyer", "One-Time Buyer", "Engaged Non-Buyer", "Single Visit", "Engaged Non-Buyer", "Single Visit"]


def test_user_dimension(spark):
    src = {"source": "google", "medium": "cpc", "name": "spring"}
    events = staging.stage_ga4_event(ga4_frame(spark, [
        ga4("u", "2024-01-01 10:00:00", "page_view", 1, 0, traffic_source=src, geo={"country": "A"}),
        ga4("u", "2024-01-01 18:00:00", "page_view", 2, 1, traffic_source={"source": "bing"}, geo={"country": "B"}),
        ga4("u", "2024-01-02 00:30:00", "purchase", 2, 2, ecommerce={"purchase_revenue_in_usd": 120.0}, geo={"country": "C"}),
        ga4("u", "2024-01-02 09:00:00", "page_view", 3, 3, geo={"country": "D"}),
    ]))
    cs = staging.stage_cs_session(cs_frame(spark, "sessions", [
        {"time": "2024-01-01 10:00:00", "user_id": "c", "session_id": "9", "session_duration": "10"}]))
    sessions = facts.session_fct(integration.unify_sessions(spark, events, contentsquare=cs))
    rows = {r.user_pk: r for r in users.user_dimension(sessions, dt.date(2024, 1, 9)).collect()}
    u, c = rows["u"], rows["c"]
    # Session 2 has two rows, one per day, and counts once.
    assert (u.total_sessions, u.conversion_sessions, u.total_purchases, u.total_revenue) == (3, 1, 1, 120.0)
    assert (u.total_events, u.avg_page_views_per_session, u.pages_per_session) == (4, 0.75, 1.0)
    assert (u.first_touch_source, u.first_touch_campaign, u.last_touch_source, u.latest_geo_country) == ("google", "spring", None, "D")
    assert (u.user_lifetime_days, u.days_since_last_visit, u.recency_segment) == (1, 7, "Active (Last 7 days)")
    assert (u.user_type, u.monetary_segment) == ("One-Time Buyer", "Medium Value ($100-$499)")
    assert (c.total_revenue, c.total_purchases, c.average_order_value) == (None, None, None)
    assert (c.monetary_segment, c.user_type, c.has_ever_purchased) == ("No Revenue", "Single Visit", 0)


def test_user_dimension_defaults_to_today(spark):
    events = staging.stage_ga4_event(ga4_frame(spark, [ga4("u", "2024-01-01 10:00:00", "page_view", 1)]))
    sessions = facts.session_fct(integration.unify_sessions(spark, events))
    assert facts.user_dim(sessions).first().recency_segment == "Inactive (90+ days)"


def test_friction_counts_do_not_fan_out(spark):
    sessions = spark.createDataFrame(
        [("contentsquare", 5, "s1"), ("contentsquare", 5, "s1"), ("contentsquare", None, "s2"), ("contentsquare", 9, "s3"), ("ga4", 5, "s4")],
        "source string, frustration_score long, ga_session_id string",
    )
    errors = spark.createDataFrame([("s1", "e1"), ("s1", "e2"), ("s1", "e2"), ("s2", "e3"), ("s4", "e4")], "ga_session_id string, js_error_pk string")
    clicks = spark.createDataFrame([("s1", f"c{n}") for n in range(4)], "ga_session_id string, rage_click_pk string")
    rows = [tuple(r) for r in analyses.friction_by_score(sessions, errors, clicks).collect()]
    assert rows == [(None, 1, 0), (5, 2, 4), (9, 0, 0)]


def test_revenue_of_a_user_does_not_depend_on_the_order_of_sessions(spark):
    """Ten times 0.1 is 1.0, which a sum of doubles misses; a number that is no amount keeps the plain sum."""
    schema = ("session_pk string, user_fk string, event_date date, ga_session_id string, session_start_ts timestamp, "
              + ", ".join(f"{c} bigint" for c in users._SUMS[:-1]) + ", purchase_revenue_per_session double, is_conversion_session bigint, "
              + ", ".join(f"{c} string" for c in (*list(users._TOUCH.values())[:3], *users._CONTEXT.values())))
    day = dt.date(2024, 1, 1)

    def row(n, user, revenue):
        return (f"{user}{n}", user, day, str(n), dt.datetime(2024, 1, 1, 0, n), 1, 1, 1, 1, 1, revenue, 1, *[None] * 8)

    amounts = {"cents": [0.1] * 10, "third": [1 / 3] * 3, "nothing": [None] * 2, "huge": [1e300, 1.0], "mixed": [None, 0.1, 0.2, 0.3]}
    rows = [row(n, user, amount) for user, of_user in amounts.items() for n, amount in enumerate(of_user)]
    got = {r.user_fk: r.purchase_revenue_per_session for r in users.user_totals(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"cents": 1.0, "third": 1.0, "nothing": None, "huge": 1e300, "mixed": 0.6}


def test_rounded_sums_equal_the_sql_at_ties(spark):
    """Halves at the last place: the double below the half goes down, as in DuckDB."""
    import duckdb

    values = [n / 1000 / k for n in range(1, 4000, 7) for k in (16, 32, 48)] + [-32.239 / 16, 0.0, 1e300, 10.9328125]
    found = spark.createDataFrame([(v,) for v in values], "v double").select(rounded(F.col("v"), T.DoubleType(), 6)).collect()
    con = duckdb.connect()
    want = [con.execute("select round(?::double, 6)", [v]).fetchone()[0] for v in values]
    assert [r[0] for r in found] == want
