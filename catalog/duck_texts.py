"""DuckDB SQL of the queries in ``spark_feeds``."""

from __future__ import annotations

from catalog.duck_queries import add
from shoptrail.plans.marts import MARTS


def _money(column: str) -> str:
    return f"cast(cast({column} as varchar) as decimal(38,9))"


add("revenue_exact", f"""
  select source, date_trunc('month', event_date)::date as month, count(*) as items, sum({_money("item_revenue")})::varchar as revenue,
    sum({_money("item_revenue_in_usd")})::varchar as revenue_usd,
    sum(cast({_money("price")} * cast(quantity as decimal(10,0)) as decimal(38,9)))::varchar as value, max({_money("item_revenue")})::varchar as largest_revenue
  from purchase_rows group by 1, 2""", "purchase_fct")

add("props_variant", """
  select event_type, count(*) as events, count(*) filter (sent is not null and not json_valid(sent)) as broken, count(*) filter (sent is null) as missing,
    count(j->>'$.k') as with_k, count(try_cast(j->>'$.k' as double)) as with_number, sum(try_cast(j->>'$.k' as double)) as k_total,
    count(j->>'$.ref') as with_ref, max(j->>'$.ref') as last_ref, count(j->>'$.deep') as with_deep, max(j->>'$.deep') as last_deep
  from (select *, case when json_valid(sent) then sent end as j from (
    select *, case event_id % 20 when 3 then '{"k": ' || k || ', "ref": "r' || (user_id % 5) || '"}' when 5 then '{"k": "many", "ref": null}'
      when 7 then '{"k": ' || k || '.5, "deep": {"list": [' || k || ', 2]}}' when 11 then '{broken' when 13 then null else props end as sent
    from (select *, props->>'$.k' as k from events)))
  group by event_type""")

_GOOD = """select {0} as kind, 'row' as part, event_name as name, count(*) as n, min(date_trunc('second', event_ts)) as first_ts, sum(n)::bigint as index_total,
    {1} as with_campaign from numbered where n % 9 <> 0 group by 3"""
_BAD = "select {0} as kind, 'rejected' as part, case {1} end as name, count(*) as n, null, null, null from numbered where n % 9 = 0 group by 3"
_PLACE = "when n // 9 % 4 = {0} then '{1}'"
add("scan_snowplow_text", " union all ".join([
    _GOOD.format("'separated'", "0"), _GOOD.format("'json'", "count(*) filter (n % 2 = 0)"),
    _BAD.format("'separated'", " ".join(_PLACE.format(*x) for x in ((0, "malformed line"), (1, "malformed line"), (2, "wrong type"), (3, "missing key")))),
    _BAD.format("'json'", " ".join(_PLACE.format(*x) for x in ((0, "malformed line"), (1, "malformed line"), (2, "wrong type"), (3, "missing key")))),
]), "s", extra="numbered as (select *, regexp_extract(event_pk, '[0-9]+')::bigint as n from s)")

add("mart_views", " union all ".join(f"select '{name}' as view_name, (select count(*) from {'funnel' if fact == 'conversion_funnel_fct' else fact}) as row_count" for name, (fact, _) in MARTS.items()),
    "session_fct", "pageview_fct", "user_dim", "add_to_cart_fct", "purchase_fct", "product_view_fct", "funnel")
add("recency_today", "select user_pk, last_seen_date, date '2024-02-15' - last_seen_date as days_before_fixed_day from user_dim", "user_dim")
