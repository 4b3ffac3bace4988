"""Registered queries over whole tables: ranks, cubes, rolling counts, states of days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.spark_queries import Feed, query
from shoptrail.operators.activity import rolling_activity
from shoptrail.operators.cubes import distinct_cube
from shoptrail.operators.funnel import STAGES
from shoptrail.operators.sketches import daily_states, over_ranges
from shoptrail.plans import segments
from shoptrail.session import work_path

CUBE = ["traffic_source_source", "traffic_source_medium", "device_category", "geo_country"]


@query("rfm_quintiles")
def _(feed: Feed) -> DataFrame:
    return segments.rfm_quintiles(feed.published("user_dim"))


@query("funnel_cube")
def _(feed: Feed) -> DataFrame:
    """Sessions and users per stage, over all combinations of source, medium, device and country."""
    events = feed.ga4.filter(F.col("event_name").isin([name for name, _ in STAGES]))
    counted = {"total": F.lit(True), **{f"with_{suffix}": F.col("event_name") == name for name, suffix in STAGES}}
    kinds = [distinct_cube(events, CUBE, who, counted).withColumn("kind", F.lit(kind)) for kind, who in (("sessions", "ga_session_id"), ("users", "user_pseudo_id"))]
    return kinds[0].unionByName(kinds[1])


@query("rolling_activity")
def _(feed: Feed) -> DataFrame:
    return rolling_activity(feed.published("session_fct"), ["source"], "event_date", "user_fk", "sessions")


def _stored_states(feed: Feed, rows: DataFrame, **columns) -> DataFrame:
    path = work_path(feed.spark, "states")
    # States are small: files by ranges of days, which a reader of some days can pass over, not a folder a day.
    states = daily_states(rows, ["source"], "event_date", **columns).repartitionByRange("event_date").sortWithinPartitions("event_date")
    states.write.parquet(path)
    return feed.spark.read.schema(states.schema).parquet(path)


def _months(rows: DataFrame) -> DataFrame:
    """The months of a table, and the whole of it."""
    month = F.trunc("event_date", "month")
    months = rows.filter("event_date is not null").select(F.date_format(month, "yyyy-MM").alias("range_name"), month.alias("range_from"), F.last_day(month).alias("range_to")).distinct()
    return months.unionByName(rows.agg(F.lit("all").alias("range_name"), F.min("event_date").alias("range_from"), F.max("event_date").alias("range_to")).filter("range_from is not null"))


@query("users_any_range")
def _(feed: Feed) -> DataFrame:
    """Estimates from stored states of days, held against the exact count."""
    rows = feed.published("session_fct")
    states = _stored_states(feed, rows, users=["user_fk"])
    found = over_ranges(states, _months(states), ["source"], "event_date", users=["user_fk"])
    ranges = found.select("range_name", F.col("source").alias("of"), "range_from", "range_to", "user_fk_estimate", "row_count")
    days = ranges.withColumn("day", F.explode(F.sequence("range_from", "range_to")))
    exact = rows.join(days, (rows["event_date"] == F.col("day")) & (rows["source"] == F.col("of"))).groupBy("range_name", "source", "user_fk_estimate", "row_count").agg(
        F.countDistinct("user_fk").alias("users")
    )
    off = F.abs(F.col("user_fk_estimate") - F.col("users")) <= F.col("users") * 0.03
    return exact.select("range_name", "source", F.col("row_count").alias("sessions"), "users", off.alias("within_3_percent"))


@query("web_vitals_p75")
def _(feed: Feed) -> DataFrame:
    """A percentile's estimate is right if its rank among the exact values is near 75 %."""
    rows = feed.published("pageview_fct").select("source", "event_date", "largest_contentful_paint", "cumulative_layout_shift")
    states = _stored_states(feed, rows, measures=["largest_contentful_paint", "cumulative_layout_shift"])
    wanted = {"largest_contentful_paint": [0.75], "cumulative_layout_shift": [0.75]}
    found = over_ranges(states, _months(states), ["source"], "event_date", measures=wanted)
    ranges = found.withColumn("day", F.explode(F.sequence("range_from", "range_to"))).withColumnRenamed("source", "of")
    met = rows.join(ranges, (rows["event_date"] == F.col("day")) & (rows["source"] == F.col("of")))
    checks = []
    for c in wanted:
        value, estimate = F.col(c), F.col(f"{c}_p75")
        below, upto = (F.try_divide(F.count_if(test), F.count(value)) for test in (value < estimate, value <= estimate))
        checks += [F.count(value).alias(f"{c}_known"), ((below <= 0.77) & (upto >= 0.73)).alias(f"{c}_p75_within_2_percent")]
    return met.groupBy("range_name", "source").agg(F.count(F.lit(1)).alias("views"), *checks)
