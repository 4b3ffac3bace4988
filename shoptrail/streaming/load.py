"""Streaming load (INC-6): read a feed's files as they arrive, drop copies,
aggregate sessions with a watermark, and merge every micro-batch by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoptrail import schemas
from shoptrail.functions.params import param_number
from shoptrail.operators.columns import conform
from shoptrail.operators.sessions import sessionise
from shoptrail.operators.upsert import merge_by_key, one_per_key
from shoptrail.plans.integration import GA4_CONTEXT
from shoptrail.session import work_path
from shoptrail.sources import tables


def read_feed(spark: SparkSession, path: str, fields: dict[str, str], files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.ddl(fields))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def without_copies(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Events once each, copies within ``delay`` of each other dropped.

    The state holds one key per event and forgets it after ``delay``.
    """
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["event_pk"])


def ga4_session_stream(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """INT-1's GA4 sessions over a stream of staged events.

    The day is a one-day window of the event time, so the state of a day goes
    once the watermark has passed it. Take it in update mode and merge it by
    key: a session's row is sent again whenever it changes.
    """
    daily = sessionise(
        events.withWatermark("event_ts", delay),
        engagement=F.coalesce(param_number("event_params", "engagement_time_msec"), F.lit(0)),
        revenue=F.col("ecommerce.purchase_revenue_in_usd"),
        context=GA4_CONTEXT,
        day=F.window("event_ts", "1 day").alias("day"),
    )
    return conform(
        daily.withColumns({"event_date": F.to_date("day.start"), "source": F.lit("ga4")}), schemas.SESSION
    )


def merge_batch(
    batch: DataFrame, path: str, keys: Sequence[str], cluster: Sequence[str] = (), newest: Sequence[str] = ()
) -> None:
    """Merge one micro-batch into the table at ``path``; doing it twice is harmless."""
    spark = batch.sparkSession
    staged = work_path(spark, "batch")
    one_per_key(batch, keys, newest).write.parquet(staged)
    rows = spark.read.schema(batch.schema).parquet(staged)
    target = tables.read_table(spark, path)
    if target is None:
        if rows.take(1):
            tables.write_days(rows, path, cluster)
    else:
        merge = merge_by_key(target, rows, keys)
        if merge.days:
            tables.exchange_days(merge.rows, path, merge.days, cluster)
    tables.remove(spark, [staged])


def merge_stream(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    mode: str = "append",
    cluster: Sequence[str] = (),
    newest: Sequence[str] = (),
) -> StreamingQuery:
    """Merge all that has arrived, then stop; start it again for what came since.

    ``checkpoint`` keeps the progress and must be a folder all executors share.
    """
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: merge_batch(batch, path, keys, cluster, newest))
        .start()
    )
