"""DuckDB SQL of the queries in ``spark_timelines``."""

from __future__ import annotations

from catalog.duck_feeds import ITEM_KEY, LABEL
from catalog.duck_queries import add

add("last_touch_before_purchase", f"""
  select p.purchase_pk, p.source, p.user_fk, event_ts as purchase_ts, transaction_id, item_id, item_revenue,
    item_revenue_in_usd as item_revenue_usd, s.session_pk as last_session_pk, s.source as last_source,
    s.session_start_ts as last_session_start_ts, s.full as last_traffic_source_full,
    date_sub('second', s.session_start_ts, event_ts) as seconds_since_session_start
  from (select *, {ITEM_KEY} as purchase_pk from purchase_rows) p left join lateral (
    select session_pk, source, session_start_ts, {LABEL} as full from session_fct t
    where t.user_fk = p.user_fk and t.session_start_ts <= p.event_ts order by t.session_start_ts desc, session_pk desc limit 1) s on true""",
    "purchase_fct")
add("friction_per_page_view", """
  select pageview_pk, source, v.user_fk, page_path, pageview_ts, view_end_ts, sum(rage)::bigint as rage_clicks,
    sum(1 - rage)::bigint as script_errors, min(happened) as first_friction_ts, max(happened) as last_friction_ts
  from (select *, pageview_ts + to_seconds(coalesce(time_on_page_seconds, 1800)) as view_end_ts from pageview_fct) v
  join (select user_fk, rage_click_ts as happened, 1 as rage from rage_click_fct
    union all select user_fk, error_ts, 0 from js_error_fct) f
    on f.user_fk = v.user_fk and pageview_ts <= happened and happened < view_end_ts
  group by all""", "pageview_fct", "rage_click_fct", "js_error_fct")
add("sessions_by_gap", """
  select user_fk, session_number, min(event_ts) as session_start_ts, max(event_ts) as session_end_ts,
    date_sub('second', min(event_ts), max(event_ts)) as session_duration_seconds, count(*) as events,
    count(*) filter (event_name = 'page_view') as page_views, count(*) filter (event_name = 'purchase') as purchases
  from (select *, sum(begins) over (partition by user_fk order by event_ts rows unbounded preceding)::bigint as session_number
    from (select user_pseudo_id as user_fk, event_ts, event_name, case when event_ts - lag(event_ts) over (partition by user_pseudo_id order by event_ts)
        <= interval 30 minutes then 0 else 1 end as begins from g where ga_session_id is null))
  group by user_fk, session_number""", "g")
