"""Registered queries on exact money, free-form properties, text feeds, views and the current day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.spark_queries import Feed, query
from shoptrail.config import Options
from shoptrail.functions.money import money, money_sum
from shoptrail.functions.variants import broken, parsed, typed, typed_paths
from shoptrail.operators.items import one_row_per_item
from shoptrail.operators.users import user_dimension
from shoptrail.plans import marts
from shoptrail.session import work_path
from shoptrail.sources import text_feeds


@query("revenue_exact")
def _(feed: Feed) -> DataFrame:
    """Item revenue per source and month without rounding: the same digits in any order."""
    items = one_row_per_item(feed.purchases)
    price, quantity = money("price"), F.col("quantity").cast("decimal(10,0)")
    rows = items.select(
        "source", F.trunc("event_date", "month").alias("month"), money("item_revenue").alias("revenue"),
        money("item_revenue_in_usd").alias("revenue_usd"), (price * quantity).try_cast("decimal(38,9)").alias("value"),
    )
    # All digits as text: no reader of the result turns them into doubles again.
    return rows.groupBy("source", "month").agg(
        F.count(F.lit(1)).alias("items"), *[money_sum(c).cast("string").alias(c) for c in ("revenue", "revenue_usd", "value")],
        F.max("revenue").cast("string").alias("largest_revenue"),
    )


# What arrives as properties: mostly as sent, some with another type, nested, broken or missing.
PROPS = """case event_id % 20 when 3 then concat('{"k": ', k, ', "ref": "r', user_id % 5, '"}') when 5 then '{"k": "many", "ref": null}'
    when 7 then concat('{"k": ', k, '.5, "deep": {"list": [', k, ', 2]}}') when 11 then '{broken' when 13 then null else props end"""


@query("props_variant")
def _(feed: Feed) -> DataFrame:
    events = feed.table("events").withColumn("k", F.get_json_object("props", "$.k")).withColumn("sent", F.expr(PROPS))
    held = events.select("event_type", "sent", parsed("sent").alias("v"))
    types = typed_paths(held, "v")  # k is text over all rows, as one of its values is
    rows = held.select("event_type", broken("sent", "v").alias("broken"), F.col("sent").isNull().alias("missing"), *typed("v", types))
    number = F.col("k").try_cast("double")
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("broken").alias("broken"), F.count_if("missing").alias("missing"),
        F.count("k").alias("with_k"), F.count(number).alias("with_number"), F.sum(number).alias("k_total"),
        F.count("ref").alias("with_ref"), F.max("ref").alias("last_ref"), F.count("deep").alias("with_deep"), F.max("deep").alias("last_deep"),
    )


SNOWPLOW_TEXT = {"event_id": "string", "event_name": "string", "collector_tstamp": "timestamp", "user_pseudo_id": "string", "session_index": "bigint"}


@query("scan_snowplow_text")
def _(feed: Feed) -> DataFrame:
    """The feed as tab-separated lines and as JSON lines, every ninth line damaged: rows in = rows good + rows rejected."""
    rows = feed.raw_snowplow.select(
        "event_id", "event_name", F.date_format("collector_tstamp", "yyyy-MM-dd HH:mm:ss").alias("collector_tstamp"), "user_pseudo_id",
        F.regexp_extract("event_id", "[0-9]+", 0).cast("bigint").alias("session_index"),
    )
    n = F.col("session_index")
    tabbed = F.concat_ws("\t", *[F.col(c).cast("string") for c in SNOWPLOW_TEXT])
    damaged = F.when(n % 9 == 0, F.element_at(F.array(
        F.concat(tabbed, F.lit("\tmore")), F.col("event_id"),
        F.concat_ws("\t", "event_id", "event_name", F.lit("yesterday"), "user_pseudo_id", n.cast("string")),
        F.concat_ws("\t", F.lit(""), "event_name", "collector_tstamp", "user_pseudo_id", n.cast("string")),
    ), (n / 9 % 4 + 1).cast("int"))).otherwise(tabbed)
    as_json = F.to_json(F.struct(*SNOWPLOW_TEXT, F.when(n % 2 == 0, n % 7).alias("campaign")))
    torn = F.when(n % 9 == 0, F.element_at(F.array(
        F.substring(as_json, 1, 30), F.lit("[1, 2]"), F.to_json(F.struct("event_id", F.lit("late").alias("collector_tstamp"))), F.to_json(F.struct("event_name", "collector_tstamp")),
    ), (n / 9 % 4 + 1).cast("int"))).otherwise(as_json)
    out = []
    for kind, line, parse in (("separated", damaged, text_feeds.parse_separated), ("json", torn, text_feeds.parse_json)):
        path = work_path(feed.spark, "lines")
        rows.select(line.alias("value")).write.text(path)
        done = parse(text_feeds.read_lines(feed.spark, path), SNOWPLOW_TEXT, ["event_id", "collector_tstamp"])
        known = F.count("campaign") if "campaign" in done.rows.columns else F.lit(0).cast("long")
        out.append(done.rows.groupBy(F.col("event_name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min("collector_tstamp").alias("first_ts"), F.sum("session_index").alias("index_total"), known.alias("with_campaign")).withColumns({"kind": F.lit(kind), "part": F.lit("row")}))
        out.append(done.rejected.groupBy(F.col("reason").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumns({"kind": F.lit(kind), "part": F.lit("rejected")}))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


@query("mart_views")
def _(feed: Feed) -> DataFrame:
    """The marts as views of the session, read by name."""
    made = marts.register_marts({fact: feed.published(fact) for fact, _ in marts.MARTS.values()})
    counted = [feed.spark.sql(f"select '{name}' as view_name, count(*) as row_count from {name}") for name in made]
    whole = counted[0]
    for part in counted[1:]:
        whole = whole.unionByName(part)
    return whole


@query("recency_today")
def _(feed: Feed) -> DataFrame:
    """Without ``as_of`` recency counts from the day of the run: shown by its distance from a fixed day."""
    fixed = dt.date(2024, 2, 15)
    users = user_dimension(feed.published("session_fct"), Options().as_of)
    since = F.datediff(F.current_date(), F.lit(fixed))
    return users.select("user_pk", "last_seen_date", (F.col("days_since_last_visit") - since).cast("bigint").alias("days_before_fixed_day"))
