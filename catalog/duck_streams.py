"""DuckDB SQL of the queries in ``spark_streams``: the same results from whole tables."""

from __future__ import annotations

from catalog.duck_feeds import ITEM_KEY
from catalog.duck_queries import SQL, add

_HEAD = "source, user_fk, ga_session_id, pageview_pk, pageview_ts, page_location"
add("stream_page_flow", f"""
  select {_HEAD}, 'flow' as kind, lead(pageview_ts) over w as next_page_ts, lag(page_location) over w as previous_page_location,
    row_number() over w as page_number_in_session, count(*) over (partition by source, user_fk, ga_session_id) as total_pages_in_session
  from pageview_fct where ga_session_id is not null and page_title is distinct from 'Page 13'
  window w as (partition by source, user_fk, ga_session_id order by pageview_ts, pageview_pk)
  union all select {_HEAD}, 'late', null, null, null, null from pageview_fct where ga_session_id is not null and page_title = 'Page 13'""", "pageview_fct")
add("stream_purchases_with_carts", f"""
  select p.purchase_pk, p.user_fk, p.item_id, purchase_ts, add_to_cart_pk, add_to_cart_ts
  from (select {ITEM_KEY} as purchase_pk, user_fk, item_id, event_ts as purchase_ts from purchase_rows) p
  left join add_to_cart_fct c on c.user_fk = p.user_fk and c.item_id = p.item_id
    and add_to_cart_ts <= purchase_ts and add_to_cart_ts >= purchase_ts - interval 7 days""", "purchase_fct", "add_to_cart_fct")
SQL["stream_sessions_by_gap"] = f"select user_fk, session_start_ts, session_end_ts, events, page_views, purchases from ({SQL['sessions_by_gap']})"
