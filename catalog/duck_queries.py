"""For each registered query the same result in DuckDB SQL."""

from __future__ import annotations

from catalog.duck_feeds import (
    AS_OF, CS_SESSION_ROWS, GEO, HOST, LABEL, PATH, QUERY, USER, event_sessions, funnel,
    key, matched, nulls, query,
)
from catalog.rounding import ROUNDED, places
from shoptrail import schemas
from shoptrail.plans.checks import INTEGRATION, STAGING, WAREHOUSE, Declared

SQL: dict[str, str] = {}


def add(name: str, select: str, *needs: str, extra: str = "") -> None:
    columns = ROUNDED.get(name)
    if columns:
        replaced = ", ".join(f"round({c}, {places(name, c)}) as {c}" for c in columns)
        select = f"select * replace ({replaced}) from ({select})"
    SQL[name] = query(select, *needs, extra=extra)


def total(column: str) -> str:
    return f"cast(sum({column}) as bigint)"


# -------------------------------------------------------------- sources, sinks
add("scan_ga4_days", """
  select event_date, event_name, count(*) as events, count(distinct user_pseudo_id) as users from g
  where event_date between date '2024-01-05' and date '2024-01-20' group by 1, 2""", "g")
add("scan_snowplow", """
  select event_name, count(*) as events, min(event_ts) as first_ts, max(event_ts) as last_ts from s group by 1""", "s")
add("scan_snowplow_days", """
  select event_ts::date as event_date, event_name, count(*) as events from s
  where event_ts::date between date '2024-01-05' and date '2024-01-20' group by 1, 2""", "s")
add("scan_contentsquare_days", """
  select ts::date as event_date, count(*) as views from ev
  where ts::date between date '2024-01-05' and date '2024-01-20' group by 1""", "ev")

_CS_TIMES = {
    "sessions": ("happened", "od"), "ecommerce_transactions": ("happened", "od"), "pageviews": ("ts", "ev"), "add_to_cart": ("ts", "ev"),
    "rage_click": ("event_ts", "cs_lines"), "excessive_hovering": ("event_ts", "cs_lines"),
}
add("scan_contentsquare", " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count, min({ts}) as first_ts, max({ts}) as last_ts from {rows}"
    for name in [*schemas.CONTENTSQUARE_TABLES, *schemas.CONTENTSQUARE_SIGNALS]
    for ts, rows in [_CS_TIMES.get(name, ("ts", "ev"))]
), "od", "ev", "cs_lines")
add("source_switches", """
  select switches, source, count(*) as sessions from session_fct
  join (values ('all', ['ga4', 'snowplow', 'contentsquare']), ('ga4 only', ['ga4']),
    ('without ga4', ['snowplow', 'contentsquare']), ('contentsquare only', ['contentsquare'])) c(switches, names)
    on list_contains(names, source)
  group by 1, 2""", "session_fct")
add("sink_days", """
  select event_date, event_type, count(*) as events, min(event_id) as first_id, max(event_id) as last_id
  from (select event_id, cast(ts as date) as event_date,
    case when cast(ts as date) >= date '2024-01-16' then 'changed' else event_type end as event_type from events)
  group by 1, 2""")
add("sink_whole_table", "select * replace (upper(c_name) as c_name) from customer")

# --------------------------------------------------------------------- staging
add("stg_ga4_event", """
  select event_pk, event_date, event_ts, user_pseudo_id, cast(ga_session_id as bigint) as ga_session_id, event_name,
    event_id as event_bundle_sequence_id,
    cast(k % 17 <> 0 as bigint) + cast(k % 31 <> 0 as bigint) + 1 + cast(k % 3 <> 0 as bigint)
      + cast(k % 5 = 0 as bigint) + cast(k % 4 <> 3 as bigint) + 1 as event_params_size,
    case when event_type in ('click', 'purchase') and k % 13 <> 0 then
      case when k % 11 = 0 then 0 else k % 3 + 1 end end as items_size,
    traffic_source_name, traffic_source_medium, traffic_source_source, device_category, device_operating_system,
    device_browser, device_language, geo_continent, geo_sub_continent, geo_country, geo_region, geo_city
  from g""", "g")
add("stg_snowplow_event", f"""
  select event_pk, event_date, event_ts, user_pseudo_id, ga_session_id, 'u' || c as user_id, event_name,
    event_pk as event_id, 'shop' as app_id, 'web' as platform, false as debug_mode,
    case when o % 13 <> 0 then o % 4 end as items_size,
    traffic_source_source, traffic_source_medium, traffic_source_name, traffic_source_content, traffic_source_term,
    device_category, device_operating_system, device_browser, device_language, browser_family, browser_name,
    browser_version, 'Browser' as browser_type, browser_viewheight, browser_viewwidth,
    o % 2 = 0 as browser_cookies_enabled, device_type, device_is_mobile, device_screen_height, device_screen_width,
    device_operating_system as os_name, 'UTC' as os_timezone, {", ".join(GEO)},
    page_location, page_url, page_title, page_referrer, page_urlhost, page_urlpath, page_urlquery, page_urlfragment,
    engagement as engagement_time_msec, {", ".join(USER)}, session_index, '10.0.0.' || (c % 250) as user_ipaddress,
    'gtm' as ga4_adapter_source, event_name as ga4_adapter_original_event_name,
    '1' as ga4_adapter_data_layer_version, 'js-3' as tracker_version
  from s""", "s")
add("stg_cs_session", """
  select *, cast(0 as bigint) as is_conversion_session, geo_region as geo_region_name from cs_sessions""", "cs_sessions")
_CS_UNKNOWN = ("select *, " + nulls("varchar", "device_category", "device_language", "browser_family", "geo_continent",
                                    "geo_sub_continent", "geo_zipcode", "geo_timezone")
               + ", " + nulls("double", "browser_version", "geo_latitude", "geo_longitude")
               + ", " + nulls("bigint", "device_screen_height", "device_screen_width"))
add("stg_cs_pageview", f"{_CS_UNKNOWN} from (select * exclude (page_location) from cs_pageviews)", "cs_pageviews")
add("stg_cs_add_to_cart", "select * from cs_carts", "cs_carts")
add("stg_cs_purchase", f"""{_CS_UNKNOWN}, {nulls("varchar", "device_browser", "browser_name", *schemas.TRAFFIC)}
  from cs_transactions""", "cs_transactions")
add("stg_cs_rage_click", f"""
  select * exclude (value), value as click_count, 'rage_click' as event_name,
    {nulls("varchar", "traffic_source_source", "traffic_source_medium")} from cs_lines""", "cs_lines")
add("stg_cs_excessive_hovering", """
  select * exclude (value), value as hover_duration, 'excessive_hovering' as event_name from cs_lines""", "cs_lines")
_API = "api_error_duration, api_error_endpoint, api_error_method, api_error_status_code"
_JS = "error_message, error_line_number, error_file_name, error_column_number"
add("stg_cs_js_error", f"select * exclude ({_API}), 'js_error' as event_name from cs_errors", "cs_errors")
add("stg_cs_api_error", f"select * exclude ({_JS}), 'api_error' as event_name from cs_errors", "cs_errors")
_SIGNALS = ", ".join(f"('{name}')" for name in schemas.CONTENTSQUARE_SIGNALS)
add("stg_cs_signals", f"""
  select event_pk, event_date, event_ts, user_pseudo_id, ga_session_id, event_id, event_name, event_type,
    device_operating_system, device_type, device_is_mobile, geo_country, geo_region, geo_city, referrer
  from cs_errors join (values {_SIGNALS}) v(event_name) on true""", "cs_errors")

# ----------------------------------------------------------------- integration
add("int_session", "select * from sessions", "session_fct")
add("int_pageview", "select * from pageviews", "pageviews")
_CONTEXT = ", ".join([*schemas.TRAFFIC, *schemas.DEVICE, *schemas.DEVICE_EXTRA, *GEO, *USER])


def _item_events(event_name: str, ga4: str, snowplow: str) -> str:
    """One row per event with its items' ids and total price."""
    def one(source: str, rows: str, items: str, extra: str) -> str:
        return f"""
  select '{source}' as source, r.event_pk, event_date, event_ts, user_pseudo_id as user_fk, ga_session_id{extra},
    coalesce(item_ids, '') as item_ids, coalesce(price_total, 0) as price_total, {_CONTEXT}
  from {rows} r left join (
    select event_pk, string_agg(item_id, ',' order by item_offset) as item_ids, sum(price) as price_total
    from {items} group by event_pk) i on r.event_pk = i.event_pk
  where event_name = '{event_name}'"""

    return one("ga4", "g", "gi", ga4) + " union all by name " + one("snowplow", "s", "si", snowplow)


_COUNTS = ", total_item_quantity, unique_items"
_NO_COUNTS = ", " + nulls("bigint", "total_item_quantity", "unique_items")
add("int_product_view", _item_events("view_item", "", ""), "gi", "si")
add("int_add_to_cart", _item_events(
    "add_to_cart", ", transaction_id" + _COUNTS, ", transaction_id" + _NO_COUNTS), "gi", "si")
add("int_purchase", _item_events(
    "purchase",
    ", transaction_id, purchase_revenue_in_usd, purchase_revenue, tax_value_in_usd, shipping_value_in_usd" + _COUNTS
    + ", cast(null as double) as ecommerce_value, cast(null as varchar) as ecommerce_currency",
    ", transaction_id, cast(null as double) as purchase_revenue_in_usd, ecommerce_value as purchase_revenue, "
    "tax as tax_value_in_usd, shipping as shipping_value_in_usd" + _NO_COUNTS + ", ecommerce_value, ecommerce_currency",
), "gi", "si")

# ------------------------------------------------------------------ facts, marts
for _fact in ("session_fct", "pageview_fct", "product_view_fct", "add_to_cart_fct", "purchase_fct", "user_dim",
              "rage_click_fct", "js_error_fct", "user_interaction_fct", "api_error_fct", "excessive_hovering_fct"):
    add(_fact, f"select * from {_fact}", _fact)
add("cs_purchase_fct", """
  select cs_purchase_pk, user_fk, event_date, ga_session_id, event_id, transaction_id, purchase_ts, event_name, event_type,
    transaction_amount, transaction_currency, device_operating_system, device_type, device_is_mobile, geo_country,
    geo_region, geo_city, geo_region_name, referrer
  from cs_purchase_fct""", "cs_purchase_fct")
add("conversion_funnel_fct", "select * from funnel", "funnel")
for _mart, _fact, _key in (
    ("sessions", "session_fct", "user_fk"), ("pageviews", "pageview_fct", "user_fk"), ("users", "user_dim", "user_pk"),
    ("add_to_cart_events", "add_to_cart_fct", "user_fk"), ("purchase_events", "purchase_fct", "user_fk"),
    ("product_views", "product_view_fct", "user_fk"),
):
    add(f"mart_{_mart}", f"select * rename ({_key} as user_pseudo_id) from {_fact}", _fact)
add("mart_conversion_funnel", "select * from funnel", "funnel")

_WHOLE = {"day": "min(event_date)", "by": ""}
_whole_sessions = (
    event_sessions("ga4", "g", "purchase_revenue_in_usd", "cast(null as bigint)", **_WHOLE) + " union all by name "
    + event_sessions("snowplow", "s", "ecommerce_value", "first(session_index order by event_ts, session_index)", **_WHOLE)
    + " union all by name " + CS_SESSION_ROWS
)
add("session_fct_whole_sessions", f"""
  select {key("source", "event_date", "user_fk", "ga_session_id")} as session_pk, * from ({_whole_sessions})""",
    "g", "s", "cs_sessions")
add("session_fct_with_transactions", """
  select source, ga_session_id, user_fk, event_date,
    case when source = 'contentsquare' then n else purchase_events_per_session end as purchase_events_per_session,
    case when source = 'contentsquare' then amount else purchase_revenue_per_session end as purchase_revenue_per_session,
    case when source = 'contentsquare' then cast(n is not null as bigint) else is_conversion_session end
      as is_conversion_session
  from session_fct left join (
    select user_pseudo_id, ga_session_id as sid, count(*) as n, sum(transaction_amount) as amount
    from cs_transactions group by 1, 2) t on user_fk = user_pseudo_id and ga_session_id = sid""",
    "session_fct", "cs_transactions")
add("funnel_strict_order", "select * from nested_funnel", "g", extra=funnel(nested=True, name="nested_funnel"))
add("funnel_user_sessions", "select * from user_funnel", "g",
    extra=funnel(session="case when ga_session_id is not null then user_pseudo_id || '/' || ga_session_id end",
                 name="user_funnel"))
add("funnel_snowplow", "select * from snowplow_funnel", "s", extra=funnel(rows="s", name="snowplow_funnel"))
add("pageview_fct_strict_urls", f"""
  select {key("source", "event_pk")} as pageview_pk, source, {matched("https?://[^/?#]+(/[^?#]*)")} as page_path,
    {matched("https?://([^/?#]+)")} as page_hostname, {QUERY} as query_string
  from pageviews""", "pageviews")

# -------------------------------------------------------------------- analyses
add("sessions_by_device", """
  select source, device_category, browser_family, device_is_mobile, geo_zipcode, count(*) as sessions
  from session_fct where device_is_mobile is not null group by all""", "session_fct")
add("slow_pages", """
  select page_path, avg(largest_contentful_paint) as avg_lcp, avg(cumulative_layout_shift) as avg_cls,
    avg(first_input_delay) as avg_fid, count(*) as pageviews
  from pageview_fct where source = 'contentsquare' and largest_contentful_paint is not null
  group by page_path having avg(largest_contentful_paint) > 2500""", "pageview_fct")
add("frustrated_users", """
  select user_fk, count(distinct ga_session_id) as sessions_with_rage, avg(frustration_score) as avg_frustration,
    count(*) as rage_click_events
  from rage_click_fct group by user_fk having count(*) > 5""", "rage_click_fct")
add("friction_by_score", """
  select s.frustration_score, count(distinct js_error_pk) as js_errors, count(distinct rage_click_pk) as rage_clicks
  from session_fct s left join js_error_fct e on s.ga_session_id = e.ga_session_id
  left join rage_click_fct r on s.ga_session_id = r.ga_session_id
  where s.source = 'contentsquare' group by 1""", "session_fct", "js_error_fct", "rage_click_fct")
add("source_comparison", f"""
  select event_date, source, count(distinct user_fk) as unique_users, count(*) as total_sessions,
    {total("page_views_per_session")} as total_pageviews, {total("purchase_events_per_session")} as total_purchases,
    sum(purchase_revenue_per_session) as total_revenue,
    sum(purchase_revenue_per_session) / count(*) as revenue_per_session
  from session_fct where event_date between date '1995-01-01' and date '2024-01-31' group by 1, 2""", "session_fct")
add("loyalty_by_browser", """
  select browser_family, user_loyalty_tier, count(*) as sessions, avg(session_duration_seconds) as avg_duration,
    sum(purchase_revenue_per_session) as revenue, count(distinct user_fk) as unique_users
  from session_fct where source = 'snowplow' and event_date >= date '1996-01-01' and user_loyalty_tier is not null
  group by 1, 2""", "session_fct")
add("top_converting_sources", """
  select traffic_source_full, total_sessions, sessions_with_purchase, session_overall_conversion_rate, users_with_purchase
  from funnel where event_date = date '2024-01-16' order by sessions_with_purchase desc, funnel_pk limit 10""", "funnel")
add("high_value_customers", """
  select user_pk as user_pseudo_id, total_revenue, total_purchases, average_order_value, user_type, monetary_segment,
    recency_segment
  from user_dim where total_revenue > 0 order by total_revenue desc, user_pk limit 100""", "user_dim")
add("product_performance", """
  select item_name, views, coalesce(carts, 0) as add_to_carts, coalesce(buys, 0) as purchases,
    coalesce(revenue, 0) as revenue, coalesce(buys, 0) / views as view_to_purchase_rate
  from (select item_id, item_name, count(*) as views from product_view_fct group by 1, 2) v
  left join (select item_id, count(*) as carts from add_to_cart_fct group by 1) c on v.item_id = c.item_id
  left join (select item_id, count(*) as buys, sum(item_revenue_usd) as revenue from purchase_fct group by 1) p
    on v.item_id = p.item_id
  order by views desc, v.item_id, item_name limit 20""", "product_view_fct", "add_to_cart_fct", "purchase_fct")
_volume = " union all ".join(
    f"select '{f}' as metric, source from {f}"
    for f in ("session_fct", "pageview_fct", "add_to_cart_fct", "purchase_fct", "product_view_fct")
)
add("volume_by_source", f"""
  select metric, coalesce(source, 'total') as source, count(*) as row_count from ({_volume})
  group by grouping sets ((metric, source), (metric))""",
    "session_fct", "pageview_fct", "add_to_cart_fct", "purchase_fct", "product_view_fct")
_KPIS = {
    "session_fct": {
        "sessions": "count(*)", "page_views": "sum(page_views_per_session)",
        "pages_per_session": "sum(page_views_per_session) / count(*)",
        "conversion_rate": "count(*) filter (where is_conversion_session = 1) / count(*)",
        "revenue": "sum(purchase_revenue_per_session)",
        "average_order_value": "sum(purchase_revenue_per_session) / sum(purchase_events_per_session)",
        "revenue_per_session": "sum(purchase_revenue_per_session) / count(*)",
    },
    "pageview_fct": {
        "bounce_rate": "count(*) filter (where total_pages_in_session = 1) / count(*) filter (where page_number_in_session = 1)",
    },
    "purchase_fct": {"purchase_items": "count(*)"},
    "user_dim": {
        "users": "count(*)", "buyers": "count(*) filter (where total_purchases > 0)",
        "buyer_share": "count(*) filter (where total_purchases > 0) / count(*)",
        "repeat_buyers": "count(*) filter (where total_purchases > 1)",
        "repeat_buyer_share": "count(*) filter (where total_purchases > 1) / count(*) filter (where total_purchases > 0)",
    },
}
add("kpi_sheet", " union all ".join([
    *[f"select '{m}' as metric, cast({e} as double) as value from {f}" for f, kpis in _KPIS.items() for m, e in kpis.items()],
    "select 'users: ' || recency_segment, cast(count(*) as double) from user_dim group by 1",
]), "session_fct", "pageview_fct", "purchase_fct", "user_dim")

# --------------------------------------------------------------------- scalars
add("param_lookup", """
  select event_id as event_bundle_sequence_id, cast(ga_session_id as bigint) as ga_session_id, page_location, page_title,
    page_referrer, session_engaged, cast(entrances as bigint) as entrances,
    case when k % 4 in (0, 1) then engagement end as engagement, cast(null as varchar) as no_such_key
  from g""", "g")
add("item_rows", """
  select event_id as event_bundle_sequence_id, item_offset, item_id, item_name, item_brand, item_variant, item_category,
    item_category2, item_category3, item_category4, item_category5, price, price_in_usd, quantity, item_revenue,
    item_revenue_in_usd, affiliation, coupon, item_list_id, item_list_name, item_list_index, promotion_id, promotion_name,
    cast(null as varchar) as creative_name, cast(null as varchar) as creative_slot, cast(null as double) as discount,
    cast(null as varchar) as index
  from gi where event_name = 'purchase'""", "gi")
add("url_parts", f"""
  select page_id, url, {PATH.replace("coalesce(page_location, page_url)", "url")} as path,
    {HOST.replace("coalesce(page_location, page_url)", "url")} as host,
    {QUERY.replace("coalesce(page_location, page_url)", "url")} as query_string,
    {matched("https?://[^/?#]+(/[^?#]*)", "url")} as strict_path, {matched("https?://([^/?#]+)", "url")} as strict_host
  from pages""")
add("text_functions", f"""
  select event_id, lower(device_type) as device_kind, device_is_mobile as is_mobile, is_first_view as first_view,
    is_last_view as last_view, {LABEL} as label, '?' || page_query as query_text,
    coalesce(page_hash, 'none') as fragment, nullif(device_type, 'tablet') as not_tablet
  from cs_pageviews""", "cs_pageviews")
add("category_levels", """
  select event_pk, 'ga4' as source, item_offset, coalesce(item_category, 'Uncategorized') as category_l1,
    nullif(item_category2, '(not set)') as category_l2, nullif(item_category3, '(not set)') as category_l3,
    nullif(item_category4, '(not set)') as category_l4, nullif(item_category5, '(not set)') as category_l5
  from gi where event_name = 'purchase'
  union all
  select event_pk, 'snowplow', item_offset, coalesce(item_category, 'Uncategorized'),
    nullif(item_category2, '(not set)'), null, null, null
  from si where event_name = 'purchase'""", "gi", "si")
_START = "timestamp '2024-01-01 12:30:00'"
add("time_functions", f"""
  select event_id, ts, cast(ts as date) as day, ts as from_micros, cast(ts as date) as cast_day,
    date_sub('second', {_START}, ts) as seconds, date_sub('hour', {_START}, ts) as hours,
    date_sub('day', {_START}, ts) as days, {AS_OF} - cast(ts as date) as days_ago, ts + interval 90 second as later,
    hour(ts) as hour_of_day, dayofweek(ts) + 1 as day_of_week
  from events""")
add("number_functions", """
  select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey,
    case when l_linenumber <> 2 then cast(l_quantity as bigint) end as whole,
    case when l_linenumber <> 2 then cast(cast(l_quantity as bigint) as double) end as real,
    cast(l_quantity as bigint) as quantity, l_extendedprice / nullif(l_linenumber - 3, 0) as shared,
    l_extendedprice * l_quantity as product, l_extendedprice / 1000.0::double as thousands,
    l_extendedprice - l_tax as difference,
    case when l_quantity >= 40 then 'large' when l_quantity >= 10 then 'medium' else 'small' end as size
  from lineitem""")
add("surrogate_keys", f"""
  select o_orderkey, {key("o_orderkey", "nullif(o_orderstatus, 'P')", "cast(o_orderdate as date)")} as order_pk
  from orders""")
add("typed_null_columns", """
  select cast(o_orderkey as varchar) as o_orderkey, o_totalprice, cast(null as varchar) as coupon,
    cast(null as double) as discount, cast(null as boolean) as is_gift, 'orders' as source
  from orders""")
_FILTERS = {
    "equal": "o_orderpriority = '1-URGENT'", "in list": "o_orderpriority in ('1-URGENT', '2-HIGH')",
    "between": "cast(o_orderdate as date) between date '1996-01-01' and date '1997-12-31'",
    "known": "nullif(o_orderstatus, 'F') is not null", "unknown": "nullif(o_orderstatus, 'F') is null",
}
add("filters", " union all ".join(
    f"select '{n}' as filter_name, o_orderstatus, count(*) as orders from orders where {c} group by 2"
    for n, c in _FILTERS.items()
))
add("after_maximum", """
  select o_orderkey, cast(o_orderdate as date) as event_date from orders
  where cast(o_orderdate as date) > (select max(cast(o_orderdate as date)) from orders
    where cast(o_orderdate as date) <= date '1999-06-30')""")

# ------------------------------------------------------------- joins, aggregates
add("left_join_totals", """
  select c_custkey, c_name, orders, first_order, spent from customer left join (
    select o_custkey, count(*) as orders, min(o_orderdate) as first_order, sum(o_totalprice) as spent
    from orders group by 1) on c_custkey = o_custkey""")
add("left_join_items", """
  select p_partkey, p_name, coalesce(sold, 0) as sold, coalesce(returned, 0) as returned from part
  left join (select l_partkey, sum(l_quantity) as sold, count(*) filter (where l_returnflag = 'R') as returned
    from lineitem group by 1) on p_partkey = l_partkey""")
add("aggregates", """
  select l_linestatus, year(l_shipdate) as ship_year, count(*) as line_count,
    count(*) filter (where l_returnflag = 'R') as returned,
    sum(case when l_returnflag = 'R' then l_extendedprice else 0 end) as returned_value,
    min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, sum(l_quantity) as quantity,
    avg(l_discount) as avg_discount, cast(max(l_shipdate) >= timestamp '2000-01-01' as bigint) as any_late,
    cast(count(*) filter (where l_returnflag = 'R') > 0 as bigint) as has_returns,
    max(l_quantity) - min(l_quantity) as quantity_range, sum(l_extendedprice) / 1000 as thousands
  from lineitem group by 1, 2""")
add("distinct_counts", """
  select o_orderstatus, count(distinct o_custkey) as customers,
    count(distinct case when o_orderpriority = '1-URGENT' then o_custkey end) as urgent_customers
  from orders group by 1""")
add("first_known_values", "select user_pseudo_id, " + ", ".join(
    f"first({c} order by event_ts, {c}) filter (where {c} is not null) as {c}"
    for c in ("device_language", "geo_city", "geo_sub_continent", "traffic_source_name")
) + " from g group by 1", "g")
add("first_and_last_order", "select o_custkey, " + ", ".join(
    f"first({c} order by o_orderdate {way}, o_orderkey {way}) as {which}_{c[2:]}"
    for which, way in (("first", "asc"), ("last", "desc")) for c in ("o_orderkey", "o_orderstatus", "o_totalprice")
) + " from orders group by 1")

# --------------------------------------------------------------- windows, sorts
_FLOW = """
  select event_id, ts as pageview_ts, user_id, event_type as page_location, lead(ts) over w as next_page_ts,
    lag(event_type) over w as previous_page_location, row_number() over w as page_number_in_session,
    count(*) over (partition by user_id) as total_pages_in_session
  from events window w as (partition by user_id order by ts, event_id)"""
add("page_flow", _FLOW)
add("page_flow_large_groups", _FLOW)
add("page_flow_null_times", """
  with e as (select event_id, case when event_id % 3 <> 0 then ts end as ts, event_type,
    case when event_id % 2 = 0 then -1 else user_id end as user_id from events)
  select event_id, ts as pageview_ts, user_id, event_type as page_location, lead(ts) over w as next_page_ts,
    lag(event_type) over w as previous_page_location, row_number() over w as page_number_in_session,
    count(*) over (partition by user_id) as total_pages_in_session
  from e window w as (partition by user_id order by ts nulls first, event_id)""")
add("top_items", """
  select l_partkey, count(*) as line_count, sum(l_quantity) as quantity from lineitem group by 1
  order by line_count desc, quantity desc, l_partkey limit 25""")
add("source_union", """
  select source, count(*) as views, count(ga_session_id) as with_session, count(page_urlhost) as with_urlhost,
    count(scroll_rate) as with_scroll
  from pageviews group by 1""", "pageviews")

# ------------------------------------------------------- incremental, streaming
add("incremental_sessions", "select * from session_fct where source = 'ga4'", "session_fct")
add("incremental_pageviews", "select * from pageview_fct where source <> 'snowplow'", "pageview_fct")
_RUN = {
    "session_fct": ("session_pk", "source = 'ga4'"), "pageview_fct": ("pageview_pk", "source <> 'snowplow'"),
    "product_view_fct": ("product_view_pk", "source = 'ga4'"), "add_to_cart_fct": ("add_to_cart_pk", "source = 'ga4'"),
    "purchase_fct": ("purchase_pk", "source = 'ga4'"), "funnel": ("funnel_pk", "true"), "js_error_fct": ("js_error_pk", "true"),
    "user_interaction_fct": ("interaction_pk", "true"), "api_error_fct": ("api_error_pk", "true"),
}
add("full_run", " union all ".join([
    *[f"select '{'conversion_funnel_fct' if f == 'funnel' else f}' as fact, count(*) as row_count, min({k}) as first_key, "
      f"max({k}) as last_key from {f} where {c}" for f, (k, c) in _RUN.items()],
    "select 'user_dim', count(distinct user_fk), min(user_fk), max(user_fk) from session_fct where source = 'ga4'",
]), *_RUN)
add("late_rows_with_lookback", """
  select cast(ts as date) as event_date, event_type, count(*) as events from events group by 1, 2""")
add("merge_by_key", """
  select o_orderkey, case when o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as o_totalprice,
    cast(date_trunc('month', o_orderdate) + case when o_orderpriority = '1-URGENT' and o_orderkey % 2 = 1
      then interval 1 month else interval 0 month end as date) as event_date
  from orders""")
add("one_row_per_key", """
  select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity
  from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1""")
add("stream_sessions", "select * from session_fct where source = 'ga4'", "session_fct")
add("stream_events_once", "select event_pk, event_date, event_ts, user_pseudo_id, event_name from g", "g")

# ------------------------------------------------------------------- data tests
_STATUS = "case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status"


def _test(model: str, column: str, kind: str, failures: str, rows: str, severity: str = "error",
          total: str = "count(*)") -> str:
    return (f"select '{model}.{column}.{kind}' as test_id, '{model}' as model, '{column}' as column, "
            f"'{severity}' as severity, cast({failures} as bigint) as failures, cast({total} as bigint) as total from {rows}")


def _repeated(column: str, rows: str) -> str:
    return f"(select {column}, count(*) as n from {rows} group by {column})"


def _declared(model: str, declared: Declared, rows: str) -> list[str]:
    tests = [
        _test(model, c, "unique", f"count(*) filter (where n > 1 and {c} is not null)", _repeated(c, rows), total="sum(n)")
        for c in declared.unique
    ]
    tests += [_test(model, c, "not_null", f"count(*) filter (where {c} is null)", rows) for c in declared.not_null]
    for c, values in declared.accepted.items():
        listed = ", ".join(f"'{v}'" for v in values)
        tests.append(_test(model, c, "accepted_values", f"count(*) filter (where {c} not in ({listed}))", rows))
    return tests


_BOTH = ("(select 'ga4' as source, event_pk, event_date, user_pseudo_id as user_fk, ga_session_id, 0 as items from g "
         "where event_name = '{0}' union all select 'snowplow', event_pk, event_date, user_pseudo_id, ga_session_id, 0 "
         "from s where event_name = '{0}')")
_ROWS = {
    "stg_ga4__event": ("(select *, event_id as event_bundle_sequence_id from g)", "g"),
    "stg_snowplow__event": ("s", "s"),
    "stg_contentsquare__pageview": ("cs_pageviews", "cs_pageviews"),
    "stg_contentsquare__add_to_cart": ("cs_carts", "cs_carts"),
    "stg_contentsquare__purchase": ("cs_transactions", "cs_transactions"),
    "stg_contentsquare__rage_click": ("cs_lines", "cs_lines"),
    "stg_contentsquare__js_error": ("cs_errors", "cs_errors"),
    "int__session": ("sessions", "session_fct"),
    "int__pageview": ("pageviews", "pageviews"),
    "int__add_to_cart": (_BOTH.format("add_to_cart"), "g"),
    "int__purchase": (_BOTH.format("purchase"), "g"),
    "int__product_view": (_BOTH.format("view_item"), "g"),
    "conversion_funnel_fct": ("funnel", "funnel"),
}
for _name, _models in (("tests_staging", STAGING), ("tests_integration", INTEGRATION), ("tests_warehouse", WAREHOUSE)):
    _tests, _needs = [], ["s"]
    for _model, _what in _models.items():
        _rows, _need = _ROWS.get(_model, (_model, _model))
        _needs.append(_need)
        _tests += _declared(_model, _what, _rows)
    add(_name, f"select *, {_STATUS} from ({' union all '.join(_tests)})", *_needs)

_LINES = "(select *, nullif(l_returnflag, 'N') as note, 'piece' as l_unit from lineitem)"
add("tests_generic", f"select *, {_STATUS}, " + """
    case when failures = 0 then null
      when test_id = 'lineitem.l_orderkey.unique' then (select cast(min(k) as varchar) from
        (select cast(l_orderkey as varchar) as k from lineitem group by l_orderkey having count(*) > 1))
      when test_id = 'lineitem.l_orderkey-l_linenumber.unique_combination_of_columns' then
        (select min(l_orderkey || '-' || l_linenumber) from
        (select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1))
      when test_id = 'lineitem.l_returnflag.accepted_values' then 'R'
      when test_id = 'lineitem.l_unit.not_constant' then 'piece'
      when test_id = 'lineitem.l_orderkey.relationships' then (select min(cast(l_orderkey as varchar)) from lineitem
        where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P'))
    end as sample from (""" + " union all ".join([
    _test("lineitem", "l_orderkey", "unique", "count(*) filter (where n > 1)", _repeated("l_orderkey", "lineitem"),
          total="sum(n)"),
    _test("lineitem", "l_orderkey-l_linenumber", "unique_combination_of_columns", "count(*) filter (where n > 1)",
          _repeated("l_orderkey, l_linenumber", "lineitem"), severity="warn", total="sum(n)"),
    _test("lineitem", "note", "not_null", "count(*) filter (where note is null)", _LINES, severity="warn"),
    _test("lineitem", "note", "not_null_where", "count(*) filter (where note is null and l_linestatus = 'F')", _LINES),
    _test("lineitem", "l_returnflag", "accepted_values", "count(*) filter (where l_returnflag not in ('A', 'N'))", _LINES),
    _test("lineitem", "l_unit", "not_constant", "cast(count(distinct l_unit) = 1 as int)", _LINES),
    _test("lineitem", "l_linenumber", "not_constant", "cast(count(distinct l_linenumber) = 1 as int)", _LINES),
    _test("lineitem", "price is positive", "expression_is_true", "count(*) filter (where l_extendedprice <= 0)", _LINES),
    _test("lineitem", "tax is low", "expression_is_true", "count(*) filter (where l_tax >= 0.05::double)", _LINES,
          severity="warn"),
    _test("lineitem", "l_orderkey", "relationships", "count(*) filter (where l_orderkey not in "
          "(select o_orderkey from orders where o_orderstatus <> 'P'))", _LINES),
]) + ")")
add("orphan_lines", """
  select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey from lineitem
  where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'O')""")
_NOT_NEGATIVE = {
    "session_fct": ("session_duration_seconds", "page_views_per_session", "events_per_session",
                    "purchase_events_per_session", "purchase_revenue_per_session"),
    "pageview_fct": ("time_on_page_seconds", "engagement_time_msec", "page_number_in_session"),
    "purchase_fct": ("item_quantity", "item_price", "item_revenue_usd"),
    "add_to_cart_fct": ("item_quantity", "item_price"),
    "user_dim": ("total_revenue", "user_lifetime_days"),
}
_logical = [
    _test(m, f"{c} >= 0", "expression_is_true", f"count(*) filter (where {c} < 0)", m)
    for m, columns in _NOT_NEGATIVE.items() for c in columns
]
_logical.append(_test("purchase_fct", "transaction_id", "not_null", "count(*) filter (where transaction_id is null)",
                      "purchase_fct", severity="warn"))
_FALLING = " and ".join(
    f"sessions_with_{a} >= sessions_with_{b}" for a, b in (
        ("pageview", "product_view"), ("product_view", "add_to_cart"), ("add_to_cart", "begin_checkout"),
        ("begin_checkout", "purchase"))
)
_logical.append(_test("conversion_funnel_fct", "stages fall", "expression_is_true", f"count(*) filter (where not ({_FALLING}))",
                      "funnel", severity="warn"))
add("tests_logical", f"select *, {_STATUS} from ({' union all '.join(_logical)})",
    *_NOT_NEGATIVE, "funnel")
add("metric_drift", """
  select *, case when abs(change) <= 0.5 then 'pass' else 'fail' end as status
  from (select *, (base_value - earlier_mean) / earlier_mean as change from (
    select max(value) filter (where month = date '1998-06-01') as base_value,
      avg(value) filter (where month < date '1998-06-01') as earlier_mean
    from (select cast(date_trunc('month', o_orderdate) as date) as month, sum(o_totalprice) as value from orders
      where o_orderdate >= date '1998-03-01' and o_orderdate < date '1998-07-01' group by 1)))""")
_OLD = "select l_orderkey, l_partkey, l_returnflag, l_quantity from lineitem"
_NEW = """select l_orderkey, l_partkey, l_returnflag,
  case when l_returnflag = 'R' then l_quantity + 1 else l_quantity end from lineitem"""
add("compare_versions", f"""
  select (select count(*) from lineitem) as old_rows, (select count(*) from lineitem) as new_rows,
    (select count(*) from ({_OLD} except all {_NEW})) as only_in_old,
    (select count(*) from ({_NEW} except all {_OLD})) as only_in_new""")
add("consistent_totals", """
  select *, case when difference <= 55 then 'pass' else 'fail' end as status
  from (select *, abs(left_total - right_total) as difference from (
    select (select sum(purchase_revenue_per_session) from session_fct) as left_total,
      (select sum(item_revenue_usd) from purchase_fct) as right_total))""", "session_fct", "purchase_fct")


# The SQL of the other queries, by topic; they use what is above.
from catalog import duck_timelines  # noqa: E402, F401 isort: skip
from catalog import duck_streams, duck_texts, duck_totals  # noqa: E402, F401
