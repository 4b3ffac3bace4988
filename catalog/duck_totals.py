"""DuckDB SQL of the queries in ``spark_totals``."""

from __future__ import annotations

from catalog.duck_feeds import _STAGES
from catalog.duck_queries import add

add("rfm_quintiles", """
  select *, recency_quintile || '' || frequency_quintile || monetary_quintile as rfm from (
    select user_pk, days_since_last_visit::integer as days_since_last_visit, total_sessions, total_revenue,
      percent_rank() over (order by days_since_last_visit desc nulls last) as recency_percent_rank,
      ntile(5) over (order by days_since_last_visit desc nulls last, user_pk nulls first) as recency_quintile,
      percent_rank() over (order by total_sessions nulls first) as frequency_percent_rank,
      ntile(5) over (order by total_sessions nulls first, user_pk nulls first) as frequency_quintile,
      percent_rank() over (order by total_revenue nulls first) as monetary_percent_rank,
      ntile(5) over (order by total_revenue nulls first, user_pk nulls first) as monetary_quintile
    from (select * replace (round(total_revenue, 2) as total_revenue) from user_dim))""", "user_dim")

_DIMENSIONS = "traffic_source_source, traffic_source_medium, device_category, geo_country"
add("funnel_cube", " union all ".join(f"""
  select {_DIMENSIONS}, grouping_id({_DIMENSIONS})::bigint as grouping_id, count(distinct {who}) as total,
    {", ".join(f"count(distinct case when event_name = '{name}' then {who} end) as with_{suffix}" for name, suffix in _STAGES)}, '{kind}' as kind
  from g where event_name in ({", ".join(f"'{name}'" for name, _ in _STAGES)}) group by cube({_DIMENSIONS})"""
    for kind, who in (("sessions", "ga_session_id"), ("users", "user_pseudo_id"))), "g")

add("rolling_activity", """
  select source, event_date, (select count(*) from f s where s.source = c.source and s.event_date = c.event_date) as sessions,
    (select count(distinct user_fk) from f s where s.source = c.source and s.event_date = c.event_date) as users,
    (select count(*) from f s where s.source = c.source and s.event_date between c.event_date - 6 and c.event_date) as sessions_7d,
    (select count(*) from f s where s.source = c.source and s.event_date between c.event_date - 27 and c.event_date) as sessions_28d,
    (select count(distinct user_fk) from f s where s.source = c.source and s.event_date between c.event_date - 6 and c.event_date) as users_7d,
    (select count(distinct user_fk) from f s where s.source = c.source and s.event_date between c.event_date - 27 and c.event_date) as users_28d
  from (select source, unnest(generate_series(min(event_date), max(event_date), interval 1 day))::date as event_date from session_fct group by source) c""",
    "session_fct", extra="f as (select source, user_fk, event_date from session_fct)")

_RANGES = """ranges as (
    select strftime(event_date, '%Y-%m') as range_name, min(date_trunc('month', event_date))::date as range_from, min(last_day(event_date)) as range_to from {0} group by 1
    union all select 'all', min(event_date), max(event_date) from {0})"""
add("users_any_range", """
  select range_name, source, count(*) as sessions, count(distinct user_fk) as users, true as within_3_percent
  from session_fct join ranges on event_date between range_from and range_to group by 1, 2""",
    "session_fct", extra=_RANGES.format("session_fct"))
add("web_vitals_p75", """
  select range_name, source, count(*) as views, count(largest_contentful_paint) as largest_contentful_paint_known,
    case when count(largest_contentful_paint) > 0 then true end as largest_contentful_paint_p75_within_2_percent,
    count(cumulative_layout_shift) as cumulative_layout_shift_known,
    case when count(cumulative_layout_shift) > 0 then true end as cumulative_layout_shift_p75_within_2_percent
  from pageview_fct join ranges on event_date between range_from and range_to group by 1, 2""",
    "pageview_fct", extra=_RANGES.format("pageview_fct"))
