"""The sample feeds and the unified rows, written independently in DuckDB SQL.

Every constant is the text of one or more common table expressions. They start
from the plain tables and give flat rows, without the nested shapes the Spark
jobs have to take apart.
"""

from __future__ import annotations

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '{NULL_TOKEN}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def pick(index: str, *values: str | None) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values) if v is not None)
    return f"case {index} {whens} end"


def nulls(kind: str, *names: str) -> str:
    return ", ".join(f"cast(null as {kind}) as {n}" for n in names)


LABEL = "coalesce(traffic_source_source, '(direct)') || ' / ' || coalesce(traffic_source_medium, '(none)')"

TRAFFIC = ["traffic_source_name", "traffic_source_medium", "traffic_source_source", "traffic_source_content",
           "traffic_source_term"]
DEVICE = ["device_category", "device_operating_system", "device_browser", "device_language"]
DEVICE_EXTRA = ["browser_family", "browser_name", "browser_version", "device_type", "device_is_mobile",
                "device_screen_height", "device_screen_width"]
GEO = ["geo_continent", "geo_sub_continent", "geo_country", "geo_region", "geo_region_name", "geo_city",
       "geo_zipcode", "geo_latitude", "geo_longitude", "geo_timezone"]
USER = ["user_customer_segment", "user_loyalty_tier", "user_subscription_status"]
CONTEXT = ", ".join([*TRAFFIC, *DEVICE, *DEVICE_EXTRA, *GEO, *USER])

# ------------------------------------------------------------------ event rows
EV = """
ev as (
  select *, cast(props->>'$.k' as bigint) as k, epoch_us(ts) as us,
    cast(floor(value * 100) as bigint) as cents,
    (epoch_us(ts) // 1000000 + 43200) // 172800 * 172800 - 43200 as session_start
  from events
)"""

G = f"""
ev_named as (
  select *, case event_type when 'view' then 'page_view' when 'purchase' then 'purchase'
      when 'signup' then 'begin_checkout'
      when 'error' then case when k % 2 = 0 then 'page_view' else 'scroll' end
      else case when k % 2 = 0 then 'view_item' else 'add_to_cart' end end as name
  from ev
),
g as (
  select {key("us", "user_id", "name", "event_id")} as event_pk,
    cast(ts as date) as event_date, ts as event_ts, cast(user_id as varchar) as user_pseudo_id,
    case when k % 17 <> 0 then cast(session_start as varchar) end as ga_session_id,
    name as event_name, event_id, event_type, k, user_id, value,
    case when k % 31 <> 0 then
      case when k % 7 = 0 then 'https://shop.example.com?x=' || k
           when k % 11 = 0 then 'https://shop.example.com/p/' || k || '#top'
           when k % 19 = 0 then 'https://shop.example.com/p/' || k || '?'
           else 'https://shop.example.com/p/' || k || '?ref=' || user_id end end as page_location,
    'Page ' || k as page_title,
    case when k % 3 <> 0 then 'https://ref.example.org/' || (k % 5) end as page_referrer,
    case when k % 5 = 0 then 1 end as entrances,
    case when k % 4 in (0, 1) then cast(cents as varchar) when k % 4 = 2 then 'abc' end as engagement_text,
    case when k % 4 in (0, 1) then cents else 0 end as engagement,
    case when k % 2 = 0 then '1' else '0' end as session_engaged,
    case when event_type = 'purchase' and k % 29 <> 0 then 'T' || event_id end as transaction_id,
    case when k % 37 <> 0 then value end as purchase_revenue_in_usd,
    value * 2 as purchase_revenue, value / 10 as tax_value_in_usd, cast(k as double) as shipping_value_in_usd,
    k % 5 as total_item_quantity, k % 4 as unique_items,
    {pick("user_id % 4", None, "spring", None, "news")} as traffic_source_name,
    {pick("user_id % 4", None, "cpc", "organic", "email")} as traffic_source_medium,
    {pick("user_id % 4", None, "google", "bing", None)} as traffic_source_source,
    {nulls("varchar", "traffic_source_content", "traffic_source_term")},
    {pick("user_id % 3", "mobile", "desktop", "tablet")} as device_category,
    {pick("user_id % 3", "iOS", "Windows", "Android")} as device_operating_system,
    {pick("user_id % 3", "Safari", "Chrome", "Firefox")} as device_browser,
    {pick("k % 3", "en", "de", None)} as device_language,
    {nulls("varchar", "browser_family", "browser_name", "device_type")},
    {nulls("double", "browser_version")}, {nulls("boolean", "device_is_mobile")},
    {nulls("bigint", "device_screen_height", "device_screen_width")},
    'C' || (user_id % 5) as geo_continent,
    case when k % 2 <> 0 then 'SC' || (user_id % 7) end as geo_sub_continent,
    'N' || (user_id % 25) as geo_country, 'R' || (k % 4) as geo_region,
    cast(null as varchar) as geo_region_name,
    case when k % 6 <> 0 then 'City' || (k % 6) end as geo_city,
    {nulls("varchar", "geo_zipcode", "geo_timezone")}, {nulls("double", "geo_latitude", "geo_longitude")},
    {nulls("varchar", *USER)}
  from ev_named
)"""

# GA4's items, one row each, with all fields the feed carries.
GI = """
g_items as (
  select *, (k + item_offset * case when k % 10 = 0 then 0 else 7 end) % 50 as n
  from (
    select *, unnest(range(k % 3 + 1)) as item_offset from g
    where event_type in ('click', 'purchase') and k % 13 <> 0 and k % 11 <> 0
  )
),
gi as (
  select *, 'SKU-' || n as item_id, 'Item ' || n as item_name, 'Brand#' || (n % 25) as item_brand,
    case when n % 2 <> 0 then 'v' || (n % 3) end as item_variant,
    case when n % 7 <> 0 then 'C' || (n % 5) end as item_category,
    case when n % 4 = 0 then '(not set)' else 'S' || (n % 6) end as item_category2,
    case when n % 3 = 0 then '(not set)' else 'T' || (n % 2) end as item_category3,
    '(not set)' as item_category4,
    case when n % 2 <> 1 then '(not set)' end as item_category5,
    n + 0.5::double as price, n + 0.25::double as price_in_usd, item_offset * (n % 3) as quantity,
    (n + 0.5::double) * 2 as item_revenue,
    case when n % 10 <> 9 then n * 1.5::double end as item_revenue_in_usd,
    case when n % 5 <> 0 then 'web' end as affiliation, case when n % 9 = 0 then 'SAVE' end as coupon,
    'L' || (n % 3) as item_list_id, 'List ' || (n % 3) as item_list_name,
    cast(item_offset as varchar) as item_list_index,
    case when n % 8 = 0 then 'P8' end as promotion_id, case when n % 8 = 0 then 'Promo' end as promotion_name,
    case when n % 6 = 0 then 'Banner' end as creative_name, case when n % 6 = 0 then 'top' end as creative_slot
  from g_items
)"""

# -------------------------------------------------------------------- Snowplow
OD = """
od as (
  select *, make_timestamp((epoch_us(o_orderdate) // 1000000 + o_orderkey * 37 % 86400) * 1000000) as happened,
    (year(o_orderdate) - 1990) // 3 as period, o_orderkey as o, o_custkey as c
  from orders
)"""

S = f"""
s as (
  select 'sp-' || o as event_pk, cast(happened as date) as event_date, happened as event_ts, cast(c as varchar) as user_pseudo_id,
    case when o % 19 <> 0 then cast(c * 10 + period as varchar) end as ga_session_id,
    case o_orderstatus when 'O' then 'page_view'
      when 'F' then case when o % 2 = 0 then 'view_item' else 'add_to_cart' end
      else case when o % 3 = 0 then 'begin_checkout' else 'purchase' end end as event_name,
    o, c, o_totalprice as ecommerce_value, o_totalprice / 100 as tax, cast(o % 10 as double) as shipping,
    case when o_orderstatus = 'P' and o % 3 <> 0 then 'O' || o end as transaction_id,
    {pick("o % 3", "USD", "EUR", None)} as ecommerce_currency,
    {pick("c % 3", "google", "letter", None)} as traffic_source_source,
    {pick("c % 3", "cpc", "email", None)} as traffic_source_medium,
    'K' || (c % 4) as traffic_source_name, case when o % 2 <> 0 then 'text' end as traffic_source_content,
    cast(null as varchar) as traffic_source_term,
    {pick("c % 3", "mobile", "desktop", "tablet")} as device_category,
    {pick("c % 3", "iOS", "Windows", "Android")} as device_operating_system,
    {pick("c % 3", "Safari", "Chrome", "Firefox")} as device_browser,
    {pick("o % 3", "en", "fr", None)} as device_language,
    {pick("c % 3", "Safari", "Chrome", "Firefox")} as browser_family,
    {pick("c % 3", "Safari 9", "Chrome 9", "Firefox 9")} as browser_name,
    c % 7 + 0.5::double as browser_version, 600 + o % 100 as browser_viewheight, 900 + o % 100 as browser_viewwidth,
    {pick("c % 3", "Mobile", "Computer", "Tablet")} as device_type, c % 3 = 0 as device_is_mobile,
    1000 + c % 9 as device_screen_height, 2000 + c % 9 as device_screen_width,
    cast(null as varchar) as geo_continent, cast(null as varchar) as geo_sub_continent,
    'N' || (c % 25) as geo_country, 'R' || (o % 4) as geo_region, 'Region ' || (o % 4) as geo_region_name,
    case when o % 6 <> 0 then 'City' || (o % 6) end as geo_city,
    lpad(cast(c % 1000 as varchar), 5, '0') as geo_zipcode,
    cast(c % 180 - 90 as double) as geo_latitude, cast(c % 360 - 180 as double) as geo_longitude,
    'UTC' as geo_timezone,
    case when o % 9 <> 0 then 'https://sp.example.com/o/' || (o % 40) || '?s=' || o end as page_location,
    'https://sp.example.com/o/' || (o % 40) as page_url, 'Order ' || (o % 40) as page_title,
    case when o % 3 <> 0 then 'https://ref.example.org/sp' end as page_referrer,
    'sp.example.com' as page_urlhost, '/o/' || (o % 40) as page_urlpath, 's=' || o as page_urlquery,
    cast(null as varchar) as page_urlfragment,
    case when o % 7 <> 0 then o % 5000 end as engagement,
    'S' || (c % 4) as user_customer_segment,
    {pick("c % 4", "gold", "silver", "bronze", None)} as user_loyalty_tier,
    {pick("c % 2", "active", "none")} as user_subscription_status,
    period as session_index
  from od
)"""

SI = """
s_items as (
  select *, (o + item_offset * 7) % 50 as n
  from (select *, unnest(range(o % 4)) as item_offset from s where o % 13 <> 0)
),
si as (
  select *, 'SKU-' || n as item_id, 'Item ' || n as item_name, 'Brand#' || (n % 25) as item_brand,
    case when n % 2 <> 0 then 'v' || (n % 3) end as item_variant,
    case when n % 7 <> 0 then 'C' || (n % 5) end as item_category,
    case when n % 4 = 0 then '(not set)' else 'S' || (n % 6) end as item_category2,
    n + 0.75::double as price, item_offset + 1 as quantity, 'shop' as affiliation,
    case when o % 5 = 0 then 'SP5' end as coupon, 'L' || (n % 3) as item_list_id, 'List ' || (n % 3) as item_list_name,
    cast(item_offset as varchar) as item_list_index
  from s_items
)"""

# --------------------------------------------------------------- ContentSquare
MOBILE = "case lower(device_type) when 'mobile' then true when 'desktop' then false end"


def place(n: str) -> str:
    return f"""{pick(f"{n} % 3", "iOS", "Windows", "Android")} as device_operating_system,
    {pick(f"{n} % 4", "Mobile", "DESKTOP", "tablet", None)} as device_type,
    'N' || ({n} % 25) as geo_country, 'R' || ({n} % 4) as geo_region,
    case when {n} % 6 <> 0 then 'City' || ({n} % 6) end as geo_city"""


def utm(n: str) -> str:
    return f"""cast(null as varchar) as traffic_source_name,
    {pick(f"{n} % 3", "cpc", "email", None)} as traffic_source_medium,
    {pick(f"{n} % 3", "google", "letter", None)} as traffic_source_source,
    case when {n} % 2 <> 0 then 'text' end as traffic_source_content,
    case when {n} % 5 = 0 then 'shoes' end as traffic_source_term"""


CSS = f"""
cs_sessions as (
  select *, {MOBILE} as device_is_mobile,
    session_start_ts + to_seconds(session_duration_seconds) as session_end_ts,
    page_views_per_session as events_per_session
  from (
    select cast(happened as date) as event_date, cast(c as varchar) as user_fk, cast(o as varchar) as ga_session_id,
      happened as session_start_ts, case when o % 5 > 1 then o % 3600 end as session_duration_seconds,
      1 + o % 9 as page_views_per_session,
      case when o % 6 <> 0 then o % 100 end as frustration_score, o % 10 as looping_index,
      case when o % 8 <> 0 then o % 50 end as page_consumption,
      {utm("c")}, {place("o")},
      {pick("c % 3", "Safari", "Chrome", "Firefox")} as device_browser,
      {pick("c % 3", "Safari", "Chrome", "Firefox")} as browser_family,
      {pick("c % 3", "Safari", "Chrome", "Firefox")} as browser_name,
      {pick("o % 3", "en", "fr", None)} as device_language
    from od
  )
)"""


def measure(value: str, bad: str) -> str:
    return f"case when not ({bad}) then ({value}) + 0.5::double end"


CSP = f"""
cs_pageviews as (
  select *, {MOBILE} as device_is_mobile, geo_region as geo_region_name,
    'https://' || coalesce(page_path, '/') as page_location
  from (
    select {key("event_id")} as event_pk, cast(ts as date) as event_date, ts as event_ts,
      cast(user_id as varchar) as user_pseudo_id, cast(session_start as varchar) as ga_session_id,
      cast(event_id as varchar) as event_id, 'page_view' as event_name,
      case when k % 13 <> 0 then '/c/' || (k % 20) end as page_path,
      case when k % 2 = 0 then 'a=' || k end as page_query, case when k % 5 = 0 then 'top' end as page_hash,
      'Page ' || k as page_title, 1 + k % 7 as view_number, k % 3 = 0 as is_first_view, k % 4 = 1 as is_last_view,
      {measure("k", "k % 10 = 3")} as scroll_rate,
      case when k % 10 <> 4 then cents end as view_duration_msec,
      {measure("k", "k % 10 = 5")} as first_input_delay,
      {measure("k + 1", "k % 10 = 6")} as interaction_to_next_paint,
      {measure("k + 2", "k % 10 = 7")} as time_to_first_byte,
      {measure("floor(value * 60)", "k % 10 = 8")} as largest_contentful_paint,
      cast('0.' || (k % 9) || '25' as double) as cumulative_layout_shift,
      case when k % 10 <> 9 then cents end as dom_interactive_after_msec, cents + 5 as fully_loaded,
      {measure("k + 3", "k % 10 = 2")} as first_contentful_paint,
      {measure("k + 4", "k % 10 = 1")} as start_render,
      600 + k as window_height, case when k % 12 <> 0 then 900 + k end as window_width,
      {utm("user_id")}, 'K' || (user_id % 4) as utm_campaign, {place("k")},
      {pick("user_id % 3", "Safari", "Chrome", "Firefox")} as device_browser,
      {pick("user_id % 3", "Safari", "Chrome", "Firefox")} as browser_name,
      case when k % 3 <> 0 then 'https://ref.example.org/' || (k % 5) end as referrer,
      'https://cs.example.com/' as landing_page, 'https://replay.example.com/' || event_id as session_replay_link
    from ev
  )
)"""

CSC = f"""
cs_carts as (
  select *, {MOBILE} as device_is_mobile, geo_region as geo_region_name
  from (
    select {key("event_id")} as event_pk, cast(ts as date) as event_date, ts as event_ts,
      cast(user_id as varchar) as user_pseudo_id, cast(session_start as varchar) as ga_session_id,
      cast(event_id as varchar) as event_id, cast(event_id + 1 as varchar) as pageview_id,
      'add_to_cart' as event_name, 'click' as event_type, '/c/' || (k % 20) as page_path,
      case when k % 2 = 0 then 'a=' || k end as page_query, cast(null as varchar) as page_hash,
      'Page ' || k as page_title, 'cs.example.com' as domain, case when k % 4 <> 0 then '/cart' end as href,
      'Add to cart' as target_text, {utm("user_id")}, 'K' || (user_id % 4) as utm_campaign, {place("k")},
      {pick("user_id % 3", "Safari", "Chrome", "Firefox")} as device_browser,
      {pick("user_id % 3", "Safari", "Chrome", "Firefox")} as browser_name,
      'https://cs.example.com/' as landing_page,
      {nulls("varchar", "referrer", "landing_page_query", "landing_page_hash", "device_category", "device_language",
             "browser_family", "geo_continent", "geo_sub_continent", "geo_zipcode", "geo_timezone")},
      {nulls("double", "browser_version", "geo_latitude", "geo_longitude")},
      {nulls("bigint", "device_screen_height", "device_screen_width")}
    from ev
  )
)"""

CST = f"""
cs_transactions as (
  select *, {MOBILE} as device_is_mobile, geo_region as geo_region_name
  from (
    select {key("o")} as event_pk, cast(happened as date) as event_date, happened as event_ts, cast(c as varchar) as user_pseudo_id,
      case when o % 4 <> 0 then cast(o as varchar) end as ga_session_id, cast(o as varchar) as event_id,
      cast(o as varchar) as transaction_id, 'purchase' as event_name, o_totalprice as transaction_amount,
      {pick("o % 3", "USD", "EUR", "GBP")} as transaction_currency, {place("o")}, 'transaction' as event_type,
      cast(null as varchar) as referrer
    from od
  )
)"""

CSL = f"""
cs_lines as (
  select *, {MOBILE} as device_is_mobile, {key("event_id")} as event_pk, cast(event_ts as date) as event_date
  from (
    select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as event_id,
      make_timestamp((epoch_us(l_shipdate) // 1000000 + l_partkey * 41 % 86400) * 1000000) as event_ts,
      cast(l_suppkey as varchar) as user_pseudo_id, cast(l_orderkey as varchar) as ga_session_id,
      cast(l_partkey as varchar) as pageview_id, l_linestatus as event_type, 'cs.example.com' as domain,
      '/c/' || (l_partkey % 20) as page_path, cast(null as varchar) as page_query, cast(null as varchar) as page_hash,
      'https://cs.example.com/' as landing_page, l_returnflag as target_text, 'div#' || l_linenumber as target_path,
      cast(l_quantity as bigint) as frustration_score, l_partkey % 600 as relative_time,
      cast(l_linenumber as bigint) as value, {place("l_partkey")}, cast(null as varchar) as referrer, 'web' as library
    from lineitem
  )
)"""

CSE = f"""
cs_errors as (
  select *, {MOBILE} as device_is_mobile
  from (
    select {key("event_id")} as event_pk, cast(ts as date) as event_date, ts as event_ts,
      cast(user_id as varchar) as user_pseudo_id, cast(event_id as varchar) as ga_session_id,
      cast(event_id as varchar) as event_id, cast(event_id + 1 as varchar) as pageview_id, event_type,
      'Error ' || (k % 9) as error_message, k as error_line_number, 'app' || (k % 3) || '.js' as error_file_name,
      k % 80 as error_column_number, k * 10 as api_error_duration, '/api/' || (k % 6) as api_error_endpoint,
      {pick("k % 2", "GET", "POST")} as api_error_method, 500 + k % 4 as api_error_status_code,
      k % 3 as errors_after_clicks, 'g' || (k % 9) as error_group_id, 'page' as error_source,
      'https://cs.example.com/' as landing_page, cast(null as varchar) as referrer, {place("k")}, 'web' as library
    from ev
  )
)"""

# ------------------------------------------------------------------- sessions
_GA4_KNOWN = ["traffic_source_name", "traffic_source_medium", "traffic_source_source", *DEVICE,
              "geo_continent", "geo_sub_continent", "geo_country", "geo_region", "geo_city"]
_ALL_CONTEXT = [*TRAFFIC, *DEVICE, *DEVICE_EXTRA, *GEO, *USER]


def _first(column: str) -> str:
    return f"first({column} order by event_ts, {column}) filter (where {column} is not null) as {column}"


def event_sessions(source: str, rows: str, revenue: str, index: str, day: str = "event_date", by: str = "event_date, ") -> str:
    context = ", ".join(_first(c) for c in _ALL_CONTEXT)
    return f"""
  select '{source}' as source, {day} as event_date, user_pseudo_id as user_fk, ga_session_id, {index} as session_index,
    min(event_ts) as session_start_ts, max(event_ts) as session_end_ts,
    date_sub('second', min(event_ts), max(event_ts)) as session_duration_seconds,
    count(*) filter (where event_name = 'page_view') as page_views_per_session, count(*) as events_per_session,
    cast(sum(coalesce(engagement, 0)) as bigint) as session_engagement_time_msec,
    count(*) filter (where event_name = 'purchase') as purchase_events_per_session,
    sum(case when event_name = 'purchase' then {revenue} else 0 end) as purchase_revenue_per_session,
    cast(count(*) filter (where event_name = 'purchase') > 0 as bigint) as is_conversion_session,
    {context}, {nulls("bigint", "frustration_score", "looping_index", "page_consumption")}
  from {rows} where ga_session_id is not null group by {by}user_pseudo_id, ga_session_id"""


GA4_SESSIONS = event_sessions("ga4", "g", "purchase_revenue_in_usd", "cast(null as bigint)")
SNOWPLOW_SESSIONS = event_sessions(
    "snowplow", "s", "ecommerce_value",
    "first(session_index order by event_ts, session_index) filter (where session_index is not null)",
)
CS_SESSION_ROWS = f"""
  select 'contentsquare' as source, event_date, user_fk, ga_session_id, cast(null as bigint) as session_index,
    session_start_ts, session_end_ts, session_duration_seconds, page_views_per_session, events_per_session,
    {nulls("bigint", "session_engagement_time_msec", "purchase_events_per_session")},
    {nulls("double", "purchase_revenue_per_session")}, cast(0 as bigint) as is_conversion_session,
    {", ".join(TRAFFIC)}, cast(null as varchar) as device_category, device_operating_system, device_browser,
    device_language, browser_family, browser_name, cast(null as double) as browser_version, device_type,
    device_is_mobile, {nulls("bigint", "device_screen_height", "device_screen_width")},
    {nulls("varchar", "geo_continent", "geo_sub_continent")}, geo_country, geo_region, geo_region as geo_region_name,
    geo_city, cast(null as varchar) as geo_zipcode, {nulls("double", "geo_latitude", "geo_longitude")},
    cast(null as varchar) as geo_timezone, {nulls("varchar", *USER)},
    frustration_score, looping_index, page_consumption
  from cs_sessions"""

SESSIONS = f"""
sessions as ({GA4_SESSIONS}
  union all by name {SNOWPLOW_SESSIONS}
  union all by name {CS_SESSION_ROWS}
),
session_fct as (
  select {key("source", "event_date", "user_fk", "ga_session_id")} as session_pk, * from sessions
)"""

# ------------------------------------------------------------------- pageviews
VITALS = ["first_input_delay", "interaction_to_next_paint", "time_to_first_byte", "largest_contentful_paint",
          "cumulative_layout_shift", "first_contentful_paint", "start_render", "scroll_rate"]
VITAL_COUNTS = ["dom_interactive_after_msec", "fully_loaded", "window_height", "window_width", "view_duration_msec"]
_PAGE_CONTEXT = [*TRAFFIC, *DEVICE, "browser_family", "browser_name", "browser_version", *GEO]
_PAGE_URL = ["page_url", "page_urlhost", "page_urlpath", "page_urlquery", "page_urlfragment"]

PAGEVIEWS = f"""
pageviews as (
  select 'ga4' as source, event_pk, event_date, event_ts as pageview_ts, user_pseudo_id as user_fk, ga_session_id,
    page_location, page_title, page_referrer, cast(entrances as bigint) as entrances,
    engagement_text as engagement_time_msec, session_engaged, {nulls("varchar", *_PAGE_URL)},
    {", ".join(_PAGE_CONTEXT)}, {nulls("bigint", "browser_viewheight", "browser_viewwidth")},
    {nulls("double", *VITALS)}, {nulls("bigint", *VITAL_COUNTS)}
  from g where event_name = 'page_view'
  union all by name
  select 'snowplow' as source, event_pk, event_date, event_ts as pageview_ts, user_pseudo_id as user_fk, ga_session_id,
    page_location, page_title, page_referrer, cast(null as bigint) as entrances,
    cast(engagement as varchar) as engagement_time_msec, cast(null as varchar) as session_engaged,
    {", ".join(_PAGE_URL)}, {", ".join(_PAGE_CONTEXT)}, browser_viewheight, browser_viewwidth,
    {nulls("double", *VITALS)}, {nulls("bigint", *VITAL_COUNTS)}
  from s where event_name = 'page_view'
  union all by name
  select 'contentsquare' as source, event_pk, event_date, event_ts as pageview_ts, user_pseudo_id as user_fk,
    ga_session_id, page_location, page_title, referrer as page_referrer, cast(is_first_view as bigint) as entrances,
    cast(view_duration_msec as varchar) as engagement_time_msec, cast(null as varchar) as session_engaged,
    page_location as page_url, cast(null as varchar) as page_urlhost, page_path as page_urlpath,
    page_query as page_urlquery, page_hash as page_urlfragment,
    {", ".join(TRAFFIC)}, cast(null as varchar) as device_category, device_operating_system, device_browser,
    cast(null as varchar) as device_language, cast(null as varchar) as browser_family, browser_name,
    cast(null as double) as browser_version, window_height as browser_viewheight, window_width as browser_viewwidth,
    {nulls("varchar", "geo_continent", "geo_sub_continent", "geo_zipcode", "geo_timezone")},
    geo_country, geo_region, geo_region_name, geo_city, {nulls("double", "geo_latitude", "geo_longitude")},
    {", ".join([*VITALS, *VITAL_COUNTS])}
  from cs_pageviews
)"""

URL = "coalesce(page_location, page_url)"


def matched(pattern: str, url: str = URL) -> str:
    return f"case when regexp_matches({url}, '{pattern}') then regexp_extract({url}, '{pattern}', 1) end"


PATH = matched("https?://[^/]+(/[^?#]*)")
HOST = matched("https?://([^/]+)")
QUERY = matched("\\?([^\\n]*)")
_NUMBER = "regexp_matches(engagement_time_msec, '^-?[0-9]+$')"

PAGEVIEW_FCT = f"""
pageview_fct as (
  select pageview_pk, source, user_fk, event_date, ga_session_id, pageview_ts, page_location, page_title, page_referrer,
    previous_page_location, {", ".join(_PAGE_URL)},
    {PATH} as page_path, {HOST} as page_hostname, {QUERY} as query_string,
    engagement as engagement_time_msec, engagement / 1000.0::double as engagement_time_seconds,
    case when next_page_ts is not null then date_sub('second', pageview_ts, next_page_ts) end as time_on_page_seconds,
    page_number_in_session, total_pages_in_session, cast(page_number_in_session = 1 as bigint) as is_entrance,
    cast(page_number_in_session = total_pages_in_session as bigint) as is_exit, coalesce(entrances, 0) as entrances,
    cast(coalesce(session_engaged, '0') = '1' as bigint) as is_engaged_session,
    {", ".join(TRAFFIC)}, {LABEL} as traffic_source_full, {", ".join(DEVICE)}, browser_family, browser_name,
    browser_version, browser_viewheight, browser_viewwidth, {", ".join(GEO)}, {", ".join([*VITALS, *VITAL_COUNTS])}
  from (
    select *, case when {_NUMBER} then cast(engagement_time_msec as bigint) else 0 end as engagement,
      lead(pageview_ts) over w as next_page_ts, lag(page_location) over w as previous_page_location,
      row_number() over w as page_number_in_session,
      count(*) over (partition by source, user_fk, ga_session_id) as total_pages_in_session
    from (select *, {key("source", "event_pk")} as pageview_pk from pageviews)
    window w as (partition by source, user_fk, ga_session_id order by pageview_ts, pageview_pk)
  )
)"""

# ------------------------------------------------------------------ item events
_CATEGORIES = "coalesce(item_category, 'Uncategorized') as category_l1, " + ", ".join(
    f"case when item_category{n} <> '(not set)' then item_category{n} end as category_l{n}" for n in range(2, 6)
)


def item_rows(event_name: str, ga4: str, snowplow: str, missing: str) -> str:
    """Item rows of both sources; ``ga4`` and ``snowplow`` name their own columns."""
    head = ("event_pk, event_date, event_ts, user_pseudo_id as user_fk, ga_session_id, item_offset, item_id, item_name, "
            "item_brand, item_variant, item_category, item_category2, price, item_list_id, item_list_name, "
            "item_list_index")
    return f"""
  select 'ga4' as source, {head}, item_category3, item_category4, item_category5, promotion_id, promotion_name,
    {ga4}, {CONTEXT}
  from gi where event_name = '{event_name}'
  union all by name
  select 'snowplow' as source, {head}, {nulls("varchar", "item_category3", "item_category4", "item_category5",
                                              "promotion_id", "promotion_name")},
    {snowplow}, {missing}, {CONTEXT}
  from si where event_name = '{event_name}'"""


ITEM_KEY = key("source", "event_pk", "item_id", "item_offset")
_ITEM_CONTEXT = f"{CONTEXT}, {LABEL} as traffic_source_full"

PRODUCT_VIEW_FCT = f"""
product_view_rows as ({item_rows(
    "view_item", "creative_name, creative_slot", "item_offset as same_offset",
    nulls("varchar", "creative_name", "creative_slot"))}
),
product_view_fct as (
  select {ITEM_KEY} as product_view_pk, source, user_fk, event_date, ga_session_id, event_ts as product_view_ts,
    item_id, item_name, item_brand, item_variant, {_CATEGORIES}, price as item_price, item_list_id, item_list_name,
    item_list_index, promotion_id, promotion_name, creative_name, creative_slot, {_ITEM_CONTEXT}
  from product_view_rows
)"""

ADD_TO_CART_FCT = f"""
add_to_cart_rows as ({item_rows(
    "add_to_cart",
    "transaction_id, total_item_quantity, unique_items, quantity, coupon, creative_name, creative_slot",
    "transaction_id, quantity, coupon",
    nulls("varchar", "creative_name", "creative_slot") + ", "
    + nulls("bigint", "total_item_quantity", "unique_items"))}
),
add_to_cart_fct as (
  select {ITEM_KEY} as add_to_cart_pk, source, user_fk, event_date, ga_session_id, event_ts as add_to_cart_ts,
    transaction_id, total_item_quantity, unique_items, item_id, item_name, item_brand, item_variant, item_category,
    item_category2, item_category3, item_category4, item_category5, price as item_price, quantity as item_quantity,
    price * quantity as item_value, coupon, item_list_id, item_list_name, item_list_index, promotion_id,
    promotion_name, creative_name, creative_slot, {_ITEM_CONTEXT}
  from add_to_cart_rows
)"""

PURCHASE_FCT = f"""
purchase_rows as ({item_rows(
    "purchase",
    "transaction_id, purchase_revenue_in_usd, purchase_revenue, tax_value_in_usd, shipping_value_in_usd, "
    "total_item_quantity, unique_items, price_in_usd, quantity, item_revenue, item_revenue_in_usd, affiliation, coupon, "
    "cast(null as double) as ecommerce_value, cast(null as varchar) as ecommerce_currency",
    "transaction_id, ecommerce_value as purchase_revenue, tax as tax_value_in_usd, shipping as shipping_value_in_usd, "
    "quantity, affiliation, coupon, ecommerce_value, ecommerce_currency",
    nulls("double", "purchase_revenue_in_usd", "price_in_usd", "item_revenue", "item_revenue_in_usd") + ", "
    + nulls("bigint", "total_item_quantity", "unique_items"))}
),
purchase_fct as (
  select {ITEM_KEY} as purchase_pk, source, p.user_fk, event_date, ga_session_id, transaction_id,
    event_ts as purchase_ts, date_sub('hour', first_session_ts, event_ts) as hours_to_purchase_from_first_visit,
    date_sub('day', first_session_ts, event_ts) as days_to_purchase_from_first_visit,
    hour(event_ts) as purchase_hour_of_day, dayofweek(event_ts) + 1 as purchase_day_of_week,
    purchase_revenue_in_usd, purchase_revenue, tax_value_in_usd, shipping_value_in_usd, total_item_quantity,
    unique_items, ecommerce_value, ecommerce_currency, item_id, item_name, item_brand, item_variant, {_CATEGORIES},
    price_in_usd as item_price_usd, price as item_price, quantity as item_quantity,
    item_revenue_in_usd as item_revenue_usd, item_revenue,
    item_revenue_in_usd / nullif(quantity, 0) as unit_price_usd, coupon, affiliation, item_list_id, item_list_name,
    promotion_id, promotion_name, {_ITEM_CONTEXT}
  from purchase_rows p
  left join (select user_fk, min(session_start_ts) as first_session_ts from session_fct group by 1) v
    on p.user_fk = v.user_fk
)"""

# ----------------------------------------------------------------- user, funnel
AS_OF = "date '2024-02-15'"


def _touch(prefix: str, order: str) -> str:
    names = {"source": "traffic_source_source", "medium": "traffic_source_medium", "campaign": "traffic_source_name",
             "date": "event_date"}
    return ", ".join(f"first({c} order by {order}) as {prefix}_touch_{n}" for n, c in names.items())


_OLDEST = "event_date, session_start_ts, session_pk"
_NEWEST = "event_date desc, session_start_ts desc, session_pk desc"
_LATEST = ", ".join(
    f"first({c} order by {_NEWEST}) as latest_{n}" for n, c in {
        "device_category": "device_category", "device_os": "device_operating_system", "geo_country": "geo_country",
        "geo_region": "geo_region", "geo_city": "geo_city"}.items()
)

USER_DIM = f"""
per_user as (
  select user_fk as user_pk, count(distinct ga_session_id) as total_sessions,
    cast(sum(page_views_per_session) as bigint) as total_page_views,
    cast(sum(events_per_session) as bigint) as total_events,
    avg(page_views_per_session) as avg_page_views_per_session,
    cast(sum(session_duration_seconds) as bigint) as total_session_duration_seconds,
    avg(session_duration_seconds) as avg_session_duration_seconds,
    cast(sum(session_engagement_time_msec) as double) / 1000 as total_engagement_time_seconds,
    max(is_conversion_session) as has_ever_purchased,
    cast(sum(purchase_events_per_session) as bigint) as total_purchases,
    count(distinct case when is_conversion_session = 1 then ga_session_id end) as conversion_sessions,
    sum(purchase_revenue_per_session) as total_revenue, min(event_date) as first_seen_date,
    max(event_date) as last_seen_date, {_touch("first", _OLDEST)}, {_touch("last", _NEWEST)}, {_LATEST}
  from session_fct group by user_fk
),
user_dim as (
  select *, total_page_views / nullif(total_sessions, 0) as pages_per_session,
    total_engagement_time_seconds / nullif(total_sessions, 0) as avg_engagement_per_session,
    conversion_sessions / nullif(total_sessions, 0) as user_conversion_rate,
    total_revenue / nullif(total_sessions, 0) as revenue_per_session,
    total_revenue / nullif(total_purchases, 0) as average_order_value,
    last_seen_date - first_seen_date as user_lifetime_days, {AS_OF} - last_seen_date as days_since_last_visit,
    case when {AS_OF} - last_seen_date <= 7 then 'Active (Last 7 days)'
      when {AS_OF} - last_seen_date <= 30 then 'Recent (Last 30 days)'
      when {AS_OF} - last_seen_date <= 90 then 'Dormant (Last 90 days)' else 'Inactive (90+ days)' end as recency_segment,
    case when total_sessions >= 10 then 'High Frequency (10+ sessions)'
      when total_sessions >= 5 then 'Medium Frequency (5-9 sessions)'
      when total_sessions >= 2 then 'Low Frequency (2-4 sessions)' else 'Single Session' end as frequency_segment,
    case when total_revenue >= 500 then 'High Value ($500+)' when total_revenue >= 100 then 'Medium Value ($100-$499)'
      when total_revenue > 0 then 'Low Value ($1-$99)' else 'No Revenue' end as monetary_segment,
    case when total_purchases > 1 then 'Repeat Buyer' when total_purchases = 1 then 'One-Time Buyer'
      when total_sessions > 1 then 'Engaged Non-Buyer' else 'Single Visit' end as user_type
  from per_user
)"""

_STAGES = (("page_view", "pageview"), ("view_item", "product_view"), ("add_to_cart", "add_to_cart"),
           ("begin_checkout", "begin_checkout"), ("purchase", "purchase"))
_SEGMENT = "event_date, traffic_source_source, traffic_source_medium, device_category, geo_country"


def funnel(rows: str = "g", session: str = "ga_session_id", nested: bool = False, name: str = "funnel") -> str:
    """The funnel with plain distinct counts, as ``name``."""
    names = ", ".join(f"'{e}'" for e, _ in _STAGES)

    def flags(column: str) -> str:
        """Per segment and ``column`` value, the stages reached."""
        hits = ", ".join(f"max(cast(event_name = '{e}' as int)) as had_{x}" for e, x in _STAGES)
        return f"select {_SEGMENT}, {column} as id, {hits} from {rows} where event_name in ({names}) group by all"

    def counts(kind: str) -> str:
        parts = [f"count(distinct id) as total_{kind}"]
        for i, (_, x) in enumerate(_STAGES):
            wanted = [y for _, y in _STAGES[: i + 1]] if nested else [x]
            condition = " and ".join(f"had_{y} = 1" for y in wanted)
            parts.append(f"count(distinct case when {condition} then id end) as {kind}_with_{x}")
        return ", ".join(parts)

    def rates(kind: str) -> str:
        one = kind[:-1]
        steps = (("pageview", "product_view", "pv_to_product_view"), ("product_view", "add_to_cart", "product_view_to_cart"),
                 ("add_to_cart", "begin_checkout", "cart_to_checkout"),
                 ("begin_checkout", "purchase", "checkout_to_purchase"))
        parts = [f"{kind}_with_{b} / nullif({kind}_with_{a}, 0) as {one}_{n}_rate" for a, b, n in steps]
        return ", ".join([*parts, f"{kind}_with_purchase / nullif(total_{kind}, 0) as {one}_overall_conversion_rate"])

    steps = (("pageview", "product_view", "product_view"), ("product_view", "add_to_cart", "cart"),
             ("add_to_cart", "begin_checkout", "checkout"), ("begin_checkout", "purchase", "purchase"))
    drops = ", ".join(
        f"sessions_with_{a} - sessions_with_{b} as sessions_dropped_at_{n}, "
        f"(sessions_with_{a} - sessions_with_{b}) / nullif(sessions_with_{a}, 0) as session_dropoff_rate_at_{n}"
        for a, b, n in steps
    )
    same = " and ".join(f"a.{c.strip()} is not distinct from b.{c.strip()}" for c in _SEGMENT.split(","))
    return f"""
{name}_counts as (
  select a.*, b.* exclude ({_SEGMENT})
  from (select {_SEGMENT}, {counts("sessions")} from ({flags(session)}) group by {_SEGMENT}) a
  join (select {_SEGMENT}, {counts("users")} from ({flags("user_pseudo_id")}) group by {_SEGMENT}) b on {same}
),
{name} as (
  select *, {key(*[c.strip() for c in _SEGMENT.split(",")])} as funnel_pk, {LABEL} as traffic_source_full,
    {rates("sessions")}, {rates("users")}, {drops}
  from {name}_counts
)"""


FUNNEL = funnel()

# --------------------------------------------------------------- friction facts
_SIGNAL = ("user_pseudo_id as user_fk, event_date, ga_session_id, pageview_id, event_id, event_type")
_WHERE = "device_operating_system, device_type, device_is_mobile, geo_country, geo_region, geo_city"
_TARGET = "domain, page_path, page_query, page_hash, landing_page, target_text, target_path, frustration_score, relative_time"
_ERROR = "errors_after_clicks, error_group_id, error_source, landing_page, referrer"

RAGE_CLICK_FCT = f"""
rage_click_fct as (
  select {key("event_pk")} as rage_click_pk, {_SIGNAL}, event_ts as rage_click_ts, 'rage_click' as event_name, {_TARGET},
    value as click_count, {nulls("varchar", "traffic_source_source", "traffic_source_medium")}, {_WHERE}, referrer, library
  from cs_lines
)"""
HOVERING_FCT = f"""
excessive_hovering_fct as (
  select {key("event_pk")} as excessive_hovering_pk, {_SIGNAL}, event_ts as hover_ts,
    'excessive_hovering' as event_name, {_TARGET}, value as hover_duration, {_WHERE}, referrer, library
  from cs_lines
)"""
JS_ERROR_FCT = f"""
js_error_fct as (
  select {key("event_pk")} as js_error_pk, {_SIGNAL}, event_ts as error_ts, 'js_error' as event_name, error_message,
    error_line_number, error_file_name, error_column_number, {_ERROR}, {_WHERE}, library
  from cs_errors
)"""
API_ERROR_FCT = f"""
api_error_fct as (
  select {key("event_pk")} as api_error_pk, {_SIGNAL}, event_ts as error_ts, 'api_error' as event_name,
    api_error_duration, api_error_endpoint, api_error_method, api_error_status_code, {_ERROR}, {_WHERE}, library
  from cs_errors
)"""
INTERACTION_FCT = f"""
user_interaction_fct as (
  select {key("event_pk")} as interaction_pk, event_ts as interaction_ts, user_pseudo_id as user_fk,
    * exclude (event_pk, event_ts, user_pseudo_id)
  from cs_carts
)"""
CS_PURCHASE_FCT = f"""
cs_purchase_fct as (
  select {key("event_pk")} as cs_purchase_pk, event_ts as purchase_ts, user_pseudo_id as user_fk,
    * exclude (event_pk, event_ts, user_pseudo_id)
  from cs_transactions
)"""

NEEDS = {
    "g": [EV, G], "gi": [EV, G, GI], "s": [OD, S], "si": [OD, S, SI],
    "cs_sessions": [OD, CSS], "cs_pageviews": [EV, CSP], "cs_carts": [EV, CSC], "cs_transactions": [OD, CST],
    "cs_lines": [CSL], "cs_errors": [EV, CSE],
    "session_fct": [EV, G, OD, S, CSS, SESSIONS],
    "pageviews": [EV, G, OD, S, CSP, PAGEVIEWS],
    "pageview_fct": [EV, G, OD, S, CSP, PAGEVIEWS, PAGEVIEW_FCT],
    "product_view_fct": [EV, G, GI, OD, S, SI, PRODUCT_VIEW_FCT],
    "add_to_cart_fct": [EV, G, GI, OD, S, SI, ADD_TO_CART_FCT],
    "purchase_fct": [EV, G, GI, OD, S, SI, CSS, SESSIONS, PURCHASE_FCT],
    "user_dim": [EV, G, OD, S, CSS, SESSIONS, USER_DIM],
    "funnel": [EV, G, FUNNEL],
    "rage_click_fct": [CSL, RAGE_CLICK_FCT], "excessive_hovering_fct": [CSL, HOVERING_FCT],
    "js_error_fct": [EV, CSE, JS_ERROR_FCT], "api_error_fct": [EV, CSE, API_ERROR_FCT],
    "user_interaction_fct": [EV, CSC, INTERACTION_FCT], "cs_purchase_fct": [OD, CST, CS_PURCHASE_FCT],
    "ev": [EV], "od": [OD],
}


def query(select: str, *needs: str, extra: str = "") -> str:
    """``select`` over the named rows, with everything they are built from."""
    parts: list[str] = []
    for need in needs:
        for part in NEEDS[need]:
            if part not in parts:
                parts.append(part)
    if extra:
        parts.append(extra)
    return f"with {','.join(parts)}\n{select}" if parts else select
