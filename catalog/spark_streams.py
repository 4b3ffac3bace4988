"""Registered queries that run as streams: several micro-batches over files that arrive in order of time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog.spark_queries import Feed, query
from shoptrail.operators.gaps import gap_session_stream
from shoptrail.operators.items import one_row_per_item
from shoptrail.plans import facts
from shoptrail.session import work_path
from shoptrail.streaming import flow, joins

# Past all feeds: a row of this time lets watermarks pass everything before it.
END = dt.datetime(2100, 1, 1)
END_MARK = "end"
ROWS_A_FILE = 500_000
VIEWS_A_BUCKET = 4_000


def _arrive(feed: Feed, rows: DataFrame, ts: str, late: Column | None = None) -> DataFrame:
    """The rows as a stream of files in order of time, read one part a batch: three parts, a row of the end, what is late.

    Every part is as many files as a batch reads, by the number of rows, and the row of the end comes in as many:
    whatever files a batch begins with, no late row is read before the batch after the first such row.
    """
    path = work_path(feed.spark, "arriving")
    times = rows.filter(F.col(ts).isNotNull())
    low, high = times.selectExpr(f"percentile_approx(unix_micros(cast({ts} as timestamp)), array(0.34, 0.67))").first()[0] or (0, 0)
    at = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(0))
    waits = F.lit(False) if late is None else F.coalesce(late, F.lit(False))
    texts = [F.lit(END_MARK).alias(c) for c, kind in rows.dtypes if kind == "string"]
    files = max(1, -(-rows.count() // (3 * ROWS_A_FILE)))
    end = rows.limit(0).unionByName(feed.spark.range(1).select(F.lit(END).cast(dict(rows.dtypes)[ts]).alias(ts), *texts), allowMissingColumns=True)
    parts = [rows.filter(~waits & (at <= low)), rows.filter(~waits & (at > low) & (at <= high)), rows.filter(~waits & (at > high)), *[end] * files, *([] if late is None else [rows.filter(waits)])]
    for part in parts:  # one after another, as the order of files is that of their times
        (part.coalesce(1) if part is end or files == 1 else part.repartition(files)).write.mode("append").parquet(path)
    return feed.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _stored(feed: Feed, rows: DataFrame) -> DataFrame:
    path = work_path(feed.spark, "rows")
    rows.write.parquet(path)
    return feed.spark.read.schema(rows.schema).parquet(path)


def _appended(feed: Feed, stream: DataFrame) -> DataFrame:
    target, progress = work_path(feed.spark, "streamed"), work_path(feed.spark, "progress")
    stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress).trigger(availableNow=True).start(target).awaitTermination()
    return feed.spark.read.schema(stream.schema).parquet(target)


@query("stream_page_flow")
def _(feed: Feed) -> DataFrame:
    """Views of page 13 arrive when all sessions are over."""
    views = facts.pageview_rows(feed.pageviews, feed.options).select(*flow.KEYS, "pageview_pk", "pageview_ts", "page_location", "page_title")
    views = _stored(feed, views)
    arriving = _arrive(feed, views, "pageview_ts", late=F.col("page_title") == "Page 13")
    target, progress = work_path(feed.spark, "streamed"), work_path(feed.spark, "progress")
    buckets = max(64, views.count() // VIEWS_A_BUCKET)
    found = flow.page_flow_stream(arriving, idle=dt.timedelta(days=2), remember=dt.timedelta(days=365_000), buckets=buckets)
    flow.write_flow(found, target, progress).awaitTermination()
    return feed.spark.read.parquet(target).drop("batch")


@query("stream_purchases_with_carts")
def _(feed: Feed) -> DataFrame:
    bought = one_row_per_item(feed.purchases).select(facts._item_key("purchase_pk"), "user_fk", "item_id", F.col("event_ts").alias("purchase_ts"))
    put = facts.add_to_cart_fct(feed.carts).select("add_to_cart_pk", "user_fk", "item_id", "add_to_cart_ts")
    stream = joins.purchases_with_carts(_arrive(feed, _stored(feed, bought), "purchase_ts"), _arrive(feed, _stored(feed, put), "add_to_cart_ts"))
    return _appended(feed, stream).filter(F.col("purchase_pk") != END_MARK)


@query("stream_sessions_by_gap")
def _(feed: Feed) -> DataFrame:
    """GA4's events without a session id: the sessions of ``sessions_by_gap``."""
    lost = feed.ga4.filter(F.col("ga_session_id").isNull()).select(F.col("user_pseudo_id").alias("user_fk"), "event_ts", "event_name")
    counts = {"page_views": F.col("event_name") == "page_view", "purchases": F.col("event_name") == "purchase"}
    found = gap_session_stream(_arrive(feed, _stored(feed, lost), "event_ts"), ["user_fk"], "event_ts", delay="1 hour", counts=counts)
    return _appended(feed, found).select("user_fk", "session_start_ts", "session_end_ts", "events", "page_views", "purchases")
