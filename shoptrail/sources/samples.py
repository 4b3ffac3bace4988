"""Feed-shaped frames out of general event, order and line tables.

The jobs read three tracking feeds. Where only plain tables are at hand
(``events``, ``orders``, ``lineitem``), these functions give them the feeds'
nested shape, row by row: every value comes from its own row, so no function
here joins, groups or shuffles, and each reads its whole table.

The derivations are arbitrary but fixed. They are chosen so that the cases the
jobs must handle occur: missing session ids, days crossed by a session,
parameters missing or sent as text, as number or as nonsense, missing and empty
item arrays, ``(not set)`` categories, URLs without path or query, the same
user and session ids in two sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(index: str, *values: str | None) -> str:
    """The value at ``index`` of a short list."""
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values) if v is not None)
    return f"case {index} {whens} end"


def _shape(rows: DataFrame, fields: dict[str, str], values: dict[str, str]) -> DataFrame:
    """All ``fields``, those without a value as typed NULLs."""
    return rows.selectExpr(*[f"cast({values.get(n, 'null')} as {kind}) as `{n}`" for n, kind in fields.items()])


def _struct(fields: dict[str, str], values: dict[str, str]) -> str:
    parts = [f"'{n}', cast({values.get(n, 'null')} as {kind})" for n, kind in fields.items()]
    return f"named_struct({', '.join(parts)})"


def _named(**values: str) -> str:
    return f"named_struct({', '.join(f"'{n}', {v}" for n, v in values.items())})"


def _event_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _derived_events(table(spark, folder, "events"))


def _derived_events(events: DataFrame) -> DataFrame:
    """``events`` with UTC time, the number in its JSON text, and a session id.

    A session lasts from noon to noon two days later, so it crosses midnight. A spread copy has them already.
    """
    if "session_start" in events.columns:
        return events
    rows = events.selectExpr(
        "*", "cast(ts as timestamp) as happened", "cast(get_json_object(props, '$.k') as bigint) as k",
        "cast(floor(value * 100) as bigint) as cents",
    )
    return rows.selectExpr("*", "(unix_timestamp(happened) + 43200) div 172800 * 172800 - 43200 as session_start")


# ------------------------------------------------------------------------ GA4
def _ga4_item(n: str) -> dict[str, str]:
    """The fields of item number ``n`` at position ``i``."""
    return {
        "item_id": f"concat('SKU-', {n})",
        "item_name": f"concat('Item ', {n})",
        "item_brand": f"concat('Brand#', {n} % 25)",
        "item_variant": f"if({n} % 2 != 0, concat('v', {n} % 3), null)",
        "item_category": f"if({n} % 7 != 0, concat('C', {n} % 5), null)",
        "item_category2": f"if({n} % 4 = 0, '(not set)', concat('S', {n} % 6))",
        "item_category3": f"if({n} % 3 = 0, '(not set)', concat('T', {n} % 2))",
        "item_category4": "'(not set)'",
        "item_category5": f"if({n} % 2 != 1, '(not set)', null)",
        "price": f"{n} + 0.5D",
        "price_in_usd": f"{n} + 0.25D",
        "quantity": f"i * ({n} % 3)",
        "item_revenue": f"({n} + 0.5D) * 2",
        "item_revenue_in_usd": f"if({n} % 10 != 9, {n} * 1.5D, null)",
        "affiliation": f"if({n} % 5 != 0, 'web', null)",
        "coupon": f"if({n} % 9 = 0, 'SAVE', null)",
        "item_list_id": f"concat('L', {n} % 3)",
        "item_list_name": f"concat('List ', {n} % 3)",
        "item_list_index": "i",
        "promotion_id": f"if({n} % 8 = 0, 'P8', null)",
        "promotion_name": f"if({n} % 8 = 0, 'Promo', null)",
        "creative_name": f"if({n} % 6 = 0, 'Banner', null)",
        "creative_slot": f"if({n} % 6 = 0, 'top', null)",
    }


def _param(key: str, text: str = "null", number: str = "null", when: str = "true") -> str:
    value = _named(string_value=f"cast({text} as string)", int_value=f"cast({number} as bigint)")
    return f"if({when}, {_named(key=f"'{key}'", value=value)}, null)"


_GA4_PAGE = """case
    when k % 7 = 0 then concat('https://shop.example.com?x=', k)
    when k % 11 = 0 then concat('https://shop.example.com/p/', k, '#top')
    when k % 19 = 0 then concat('https://shop.example.com/p/', k, '?')
    else concat('https://shop.example.com/p/', k, '?ref=', user_id) end"""
_GA4_PARAMS = ", ".join([
    _param("ga_session_id", number="session_start", when="k % 17 != 0"),
    _param("page_location", _GA4_PAGE, when="k % 31 != 0"),
    _param("page_title", "concat('Page ', k)"),
    _param("page_referrer", "concat('https://ref.example.org/', k % 5)", when="k % 3 != 0"),
    _param("entrances", number="1", when="k % 5 = 0"),
    _param(
        "engagement_time_msec", "case k % 4 when 1 then cast(cents as string) when 2 then 'abc' end",
        "if(k % 4 = 0, cents, null)", when="k % 4 != 3",
    ),
    _param("session_engaged", "if(k % 2 = 0, '1', '0')"),
])
_GA4_NUMBER = "((k + i * if(k % 10 = 0, 0, 7)) % 50)"
_GA4_ITEMS = f"transform(sequence(0L, k % 3), i -> {_struct(schemas.GA4_ITEM_FIELDS, _ga4_item(_GA4_NUMBER))})"
_GA4 = {
    "event_date": "date_format(happened, 'yyyyMMdd')",
    "event_timestamp": "unix_micros(happened)",
    "event_name": """case event_type
        when 'view' then 'page_view' when 'purchase' then 'purchase' when 'signup' then 'begin_checkout'
        when 'error' then if(k % 2 = 0, 'page_view', 'scroll')
        else if(k % 2 = 0, 'view_item', 'add_to_cart') end""",
    "event_bundle_sequence_id": "event_id",
    "user_pseudo_id": "user_id",
    "event_params": f"array_compact(array({_GA4_PARAMS}))",
    "ecommerce": _named(
        transaction_id="if(event_type = 'purchase' and k % 29 != 0, concat('T', event_id), null)",
        purchase_revenue_in_usd="if(k % 37 != 0, value, null)",
        purchase_revenue="value * 2",
        tax_value_in_usd="value / 10",
        shipping_value_in_usd="cast(k as double)",
        total_item_quantity="k % 5",
        unique_items="k % 4",
    ),
    "items": f"""case when event_type in ('click', 'purchase') and k % 13 != 0
        then slice({_GA4_ITEMS}, 1, if(k % 11 = 0, 0, 3)) end""",
    "traffic_source": _named(
        name=_pick("user_id % 4", None, "spring", None, "news"),
        medium=_pick("user_id % 4", None, "cpc", "organic", "email"),
        source=_pick("user_id % 4", None, "google", "bing", None),
    ),
    "device": _named(
        category=_pick("user_id % 3", "mobile", "desktop", "tablet"),
        operating_system=_pick("user_id % 3", "iOS", "Windows", "Android"),
        language=_pick("k % 3", "en", "de", None),
        web_info=_named(browser=_pick("user_id % 3", "Safari", "Chrome", "Firefox")),
    ),
    "geo": _named(
        continent="concat('C', user_id % 5)",
        sub_continent="if(k % 2 != 0, concat('SC', user_id % 7), null)",
        country="concat('N', user_id % 25)",
        region="concat('R', k % 4)",
        city="if(k % 6 != 0, concat('City', k % 6), null)",
    ),
}


def ga4_events(spark: SparkSession, folder: str) -> DataFrame:
    """GA4's shape out of ``events``."""
    return _shape(_event_rows(spark, folder), schemas.GA4_EVENTS, _GA4)


def ga4_events_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows, gathered and sorted by day while they are still plain rows of ``events``.

    The nested rows are many times as large: shuffling and sorting those spills.
    """
    days = table(spark, folder, "events").withColumn("event_date", F.expr("date_format(cast(ts as timestamp), 'yyyyMMdd')"))
    gathered = days.hint("rebalance", "event_date").sortWithinPartitions("event_date")
    return _shape(_derived_events(gathered), schemas.GA4_EVENTS, {**_GA4, "event_date": "event_date"})


# ------------------------------------------------------------------- Snowplow
def _order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` with a time of day and an id of the three-year period."""
    return table(spark, folder, "orders").selectExpr(
        "*", "o_orderkey as o", "o_custkey as c",
        "timestamp_seconds(unix_timestamp(cast(o_orderdate as timestamp)) + o_orderkey * 37 % 86400) as happened",
        "cast((year(o_orderdate) - 1990) div 3 as bigint) as period",
    )


def _snowplow_item(n: str) -> dict[str, str]:
    return {
        "item_id": f"concat('SKU-', {n})",
        "item_name": f"concat('Item ', {n})",
        "item_brand": f"concat('Brand#', {n} % 25)",
        "item_variant": f"if({n} % 2 != 0, concat('v', {n} % 3), null)",
        "item_category": f"if({n} % 7 != 0, concat('C', {n} % 5), null)",
        "item_category2": f"if({n} % 4 = 0, '(not set)', concat('S', {n} % 6))",
        "price": f"{n} + 0.75D",
        "quantity": "i + 1",
        "affiliation": "'shop'",
        "coupon": "if(o % 5 = 0, 'SP5', null)",
        "item_list_id": f"concat('L', {n} % 3)",
        "item_list_name": f"concat('List ', {n} % 3)",
        "index": "i",
        "discount": "i / 2D",
    }


_SP_NUMBER = "((o + i * 7) % 50)"
_SP_ITEMS = f"transform(sequence(0L, o % 4), i -> {_struct(schemas.SNOWPLOW_ITEM_FIELDS, _snowplow_item(_SP_NUMBER))})"
_SP_NAME = """case o_orderstatus when 'O' then 'page_view' when 'F' then if(o % 2 = 0, 'view_item', 'add_to_cart')
    else if(o % 3 = 0, 'begin_checkout', 'purchase') end"""
_SP_URL = "concat('https://sp.example.com/o/', o % 40)"
_SNOWPLOW = {
    "event_id": "concat('sp-', o)",
    "user_pseudo_id": "c",
    "user_id": "concat('u', c)",
    "session_id": "if(o % 19 != 0, c * 10 + period, null)",
    "collector_tstamp": "happened",
    "dvce_created_tstamp": "happened",
    "etl_tstamp": "happened",
    "event_name": _SP_NAME,
    "app_id": "'shop'",
    "platform": "'web'",
    "debug_mode": "false",
    "ecommerce": _named(
        transaction_id="if(o_orderstatus = 'P' and o % 3 != 0, concat('O', o), null)",
        value="o_totalprice",
        tax="o_totalprice / 100",
        shipping="cast(o % 10 as double)",
        currency=_pick("o % 3", "USD", "EUR", None),
        items=f"if(o % 13 != 0, slice({_SP_ITEMS}, 1, cast(o % 4 as int)), null)",
    ),
    "traffic_source": _named(
        source=_pick("c % 3", "google", "letter", None),
        medium=_pick("c % 3", "cpc", "email", None),
        campaign="concat('K', c % 4)",
        content="if(o % 2 != 0, 'text', null)",
        term="cast(null as string)",
    ),
    "device": _named(
        category=_pick("c % 3", "mobile", "desktop", "tablet"),
        os=_pick("c % 3", "iOS", "Windows", "Android"),
        browser=_pick("c % 3", "Safari", "Chrome", "Firefox"),
    ),
    "br_lang": _pick("o % 3", "en", "fr", None),
    "br_family": _pick("c % 3", "Safari", "Chrome", "Firefox"),
    "br_name": _pick("c % 3", "Safari 9", "Chrome 9", "Firefox 9"),
    "br_version": "c % 7 + 0.5D",
    "br_type": "'Browser'",
    "br_viewheight": "600 + o % 100",
    "br_viewwidth": "900 + o % 100",
    "br_cookies": "o % 2 = 0",
    "dvce_type": _pick("c % 3", "Mobile", "Computer", "Tablet"),
    "dvce_ismobile": "c % 3 = 0",
    "dvce_screenheight": "1000 + c % 9",
    "dvce_screenwidth": "2000 + c % 9",
    "os_name": _pick("c % 3", "iOS", "Windows", "Android"),
    "os_timezone": "'UTC'",
    "geo": _named(
        country="concat('N', c % 25)",
        region="concat('R', o % 4)",
        region_name="concat('Region ', o % 4)",
        city="if(o % 6 != 0, concat('City', o % 6), null)",
        zipcode="lpad(cast(c % 1000 as string), 5, '0')",
        timezone="'UTC'",
        latitude="cast(c % 180 - 90 as double)",
        longitude="cast(c % 360 - 180 as double)",
    ),
    "page_location": f"if(o % 9 != 0, concat({_SP_URL}, '?s=', o), null)",
    "page_url": _SP_URL,
    "page_title": "concat('Order ', o % 40)",
    "page_referrer": "if(o % 3 != 0, 'https://ref.example.org/sp', null)",
    "page_urlhost": "'sp.example.com'",
    "page_urlpath": "concat('/o/', o % 40)",
    "page_urlquery": "concat('s=', o)",
    "engagement_time_msec": "if(o % 7 != 0, o % 5000, null)",
    "user_properties": _named(
        customer_segment="concat('S', c % 4)",
        loyalty_tier=_pick("c % 4", "gold", "silver", "bronze", None),
        subscription_status=_pick("c % 2", "active", "none"),
    ),
    "domain_sessionidx": "period",
    "user_ipaddress": "concat('10.0.0.', c % 250)",
    "ga4_adapter": _named(source="'gtm'", original_event_name=_SP_NAME, data_layer_version="'1'"),
    "v_tracker": "'js-3'",
}


def snowplow_events(spark: SparkSession, folder: str) -> DataFrame:
    """Snowplow's shape out of ``orders``."""
    return _shape(_order_rows(spark, folder), schemas.SNOWPLOW_EVENTS, _SNOWPLOW)


# -------------------------------------------------------------- ContentSquare
def _place(n: str) -> dict[str, str]:
    return {
        "platform": _pick(f"{n} % 3", "iOS", "Windows", "Android"),
        "device_type": _pick(f"{n} % 4", "Mobile", "DESKTOP", "tablet", None),
        "country": f"concat('N', {n} % 25)",
        "region": f"concat('R', {n} % 4)",
        "city": f"if({n} % 6 != 0, concat('City', {n} % 6), null)",
    }


def _utm(n: str) -> dict[str, str]:
    return {
        "utm_medium": _pick(f"{n} % 3", "cpc", "email", None),
        "utm_source": _pick(f"{n} % 3", "google", "letter", None),
        "utm_content": f"if({n} % 2 != 0, 'text', null)",
        "utm_term": f"if({n} % 5 = 0, 'shoes', null)",
        "utm_campaign": f"concat('K', {n} % 4)",
    }


def _measure(n: str, bad: str) -> str:
    """A number sent as text, sometimes nonsense."""
    return f"if({bad}, 'abc', concat({n}, '.5'))"


_BROWSER_OF_USER = _pick("user_id % 3", "Safari", "Chrome", "Firefox")
_FROM_EVENT = {"event_id": "event_id", "user_id": "user_id", "session_id": "session_start", "time": "happened"}
_CS_SESSIONS = {
    "time": "happened",
    "user_id": "c",
    "session_id": "o",
    "session_duration": "case when o % 5 = 0 then 'abc' when o % 5 > 1 then cast(o % 3600 as string) end",
    "session_number_of_views": "1 + o % 9",
    "frustration_score": "if(o % 6 != 0, o % 100, null)",
    "looping_index": "o % 10",
    "page_consumption": "if(o % 8 = 0, '12.5', cast(o % 50 as string))",
    **_utm("c"),
    **_place("o"),
    "browser": _pick("c % 3", "Safari", "Chrome", "Firefox"),
    "session_language": _pick("o % 3", "en", "fr", None),
}
_CS_PAGEVIEWS = {
    **_FROM_EVENT,
    **_place("k"),
    "referrer": "if(k % 3 != 0, concat('https://ref.example.org/', k % 5), null)",
    "path": "if(k % 13 != 0, concat('/c/', k % 20), null)",
    "query": "if(k % 2 = 0, concat('a=', k), null)",
    "hash": "if(k % 5 = 0, 'top', null)",
    "title": "concat('Page ', k)",
    "view_number": "1 + k % 7",
    "is_first": _pick("k % 3", "1", "0", None),
    "is_last": _pick("k % 4", "0", "1", None, None),
    "scroll_rate": _measure("k", "k % 10 = 3"),
    "view_duration_msec": "if(k % 10 = 4, '12.5', cast(cents as string))",
    "first_input_delay": _measure("k", "k % 10 = 5"),
    "interaction_to_next_paint": _measure("k + 1", "k % 10 = 6"),
    "time_to_first_byte": _measure("k + 2", "k % 10 = 7"),
    "largest_contentful_paint": _measure("cast(floor(value * 60) as bigint)", "k % 10 = 8"),
    "cumulative_layout_shift": "concat('0.', k % 9, '25')",
    "dom_interactive_after_msec": "if(k % 10 = 9, 'abc', cast(cents as string))",
    "fully_loaded": "cents + 5",
    "first_contentful_paint": _measure("k + 3", "k % 10 = 2"),
    "start_render": _measure("k + 4", "k % 10 = 1"),
    "window_height": "600 + k",
    "window_width": "if(k % 12 = 0, '', cast(900 + k as string))",
    **_utm("user_id"),
    "browser": _BROWSER_OF_USER,
    "landing_page": "'https://cs.example.com/'",
    "session_replay_link": "concat('https://replay.example.com/', event_id)",
}
_CS_ADD_TO_CART = {
    **_FROM_EVENT,
    "type": "'click'",
    **_place("k"),
    "pageview_id": "event_id + 1",
    "path": "concat('/c/', k % 20)",
    "query": "if(k % 2 = 0, concat('a=', k), null)",
    "title": "concat('Page ', k)",
    "domain": "'cs.example.com'",
    "href": "if(k % 4 != 0, '/cart', null)",
    "target_text": "'Add to cart'",
    **_utm("user_id"),
    "browser": _BROWSER_OF_USER,
    "landing_page": "'https://cs.example.com/'",
}
_CS_TRANSACTIONS = {
    "event_id": "o",
    "user_id": "c",
    "session_id": "if(o % 4 != 0, o, null)",
    "time": "happened",
    "type": "'transaction'",
    **_place("o"),
    "transaction_amount": "o_totalprice",
    "transaction_currency": _pick("o % 3", "USD", "EUR", "GBP"),
}
# Friction signals out of lines: an order's lines are one session's.
_CS_LINE_SIGNAL = {
    "event_id": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
    "user_id": "l_suppkey",
    "session_id": "l_orderkey",
    "time": "timestamp_seconds(unix_timestamp(cast(l_shipdate as timestamp)) + l_partkey * 41 % 86400)",
    "type": "l_linestatus",
    **_place("l_partkey"),
    "pageview_id": "l_partkey",
    "domain": "'cs.example.com'",
    "path": "concat('/c/', l_partkey % 20)",
    "landing_page": "'https://cs.example.com/'",
    "target_text": "l_returnflag",
    "target_path": "concat('div#', l_linenumber)",
    "frustration_score": "l_quantity",
    "relative_time": "l_partkey % 600",
    "value": "l_linenumber",
    "library": "'web'",
}
_CS_ERROR = {
    **_FROM_EVENT,
    "session_id": "event_id",
    "type": "event_type",
    **_place("k"),
    "pageview_id": "event_id + 1",
    "error_message": "concat('Error ', k % 9)",
    "error_line_number": "k",
    "js_error_file_name": "concat('app', k % 3, '.js')",
    "js_error_column_number": "k % 80",
    "api_error_duration": "k * 10",
    "api_error_endpoint": "concat('/api/', k % 6)",
    "api_error_method": _pick("k % 2", "GET", "POST"),
    "api_error_status_code": "500 + k % 4",
    "errors_after_clicks": "k % 3",
    "error_group_id": "concat('g', k % 9)",
    "error_source": "'page'",
    "landing_page": "'https://cs.example.com/'",
    "library": "'web'",
}
_CS_TABLES = {
    "sessions": (_order_rows, _CS_SESSIONS),
    "pageviews": (_event_rows, _CS_PAGEVIEWS),
    "add_to_cart": (_event_rows, _CS_ADD_TO_CART),
    "ecommerce_transactions": (_order_rows, _CS_TRANSACTIONS),
    "rage_click": (lambda spark, folder: table(spark, folder, "lineitem"), _CS_LINE_SIGNAL),
    "excessive_hovering": (lambda spark, folder: table(spark, folder, "lineitem"), _CS_LINE_SIGNAL),
    "js_errors": (_event_rows, _CS_ERROR),
    "api_errors": (_event_rows, _CS_ERROR),
}


def contentsquare(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One ContentSquare table's shape.

    The tables of which no columns are published get the common ones.
    """
    if name in schemas.CONTENTSQUARE_SIGNALS:
        errors = contentsquare(spark, folder, "js_errors")
        return errors.select(
            "event_id", "user_id", "session_id", "time", "type", "platform", "device_type",
            "country", "region", "city", "referrer",
        )
    rows, values = _CS_TABLES[name]
    return _shape(rows(spark, folder), schemas.CONTENTSQUARE_TABLES[name], values)


ROWS_A_FILE = 500_000
_KEY = {"events": "event_id", "orders": "o_orderkey", "lineitem": "l_orderkey"}
# What of a line the signals are made of.
_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_linestatus", "l_returnflag", "l_quantity")


def base_of(name: str) -> str:
    """The plain table that a ContentSquare table is made of."""
    return {_event_rows: "events", _order_rows: "orders"}.get(_CS_TABLES["js_errors" if name in schemas.CONTENTSQUARE_SIGNALS else name][0], "lineitem")


def spread_table(spark: SparkSession, folder: str, name: str, target: str, files: int = 8) -> None:
    """Copy a table the feeds are made of in several files, more for more rows.

    A table of one small file is read by one task, and so are its feeds. Rows are dealt by key: dealing
    them in turn sorts all rows first. All rows are copied, with the columns the feeds are made of. The number in
    an event's JSON text becomes a column here: a condition on a feed's parameter is pushed down to the scan with
    every mention of that number in it, and would parse the text for each.
    """
    rows = table(spark, folder, name)
    dealt = rows.repartition(max(files, rows.count() // ROWS_A_FILE + 1), _KEY[name])
    if name == "events":
        dealt = _derived_events(dealt).drop("props", "ts")
    elif name == "lineitem":
        dealt = dealt.select(*_LINE)
    dealt.write.parquet(f"{target}/{name}.parquet")
