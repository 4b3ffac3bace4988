"""Scans of the raw feeds (SRC-1..12). All feeds are Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas


def read_ga4(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """GA4 events between two days (``YYYYMMDD``, both included).

    The folder is partitioned by ``event_date``, so the day range is settled
    by partition pruning and other days' files are not opened.
    """
    events = spark.read.schema(schemas.ddl(schemas.GA4_EVENTS)).parquet(path)
    if start is not None:
        events = events.filter(F.col("event_date") >= start)
    if end is not None:
        events = events.filter(F.col("event_date") <= end)
    return events


def _between(rows: DataFrame, moment: str, start: str | None, end: str | None) -> DataFrame:
    """Rows of whole days (``YYYYMMDD``, both included) by a timestamp column.

    The bounds are constants compared with the bare column, so Parquet skips the
    row groups of other days. Rows without a time are in no range.
    """
    def midnight(day: str):
        return F.to_date(F.lit(day), "yyyyMMdd")

    if start is not None:
        rows = rows.filter(F.col(moment) >= midnight(start).cast("timestamp"))
    if end is not None:
        rows = rows.filter(F.col(moment) < F.date_add(midnight(end), 1).cast("timestamp"))
    return rows


def read_snowplow(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Snowplow events, of a range of collection days if one is given."""
    events = spark.read.schema(schemas.ddl(schemas.SNOWPLOW_EVENTS)).parquet(path)
    return _between(events, "collector_tstamp", start, end)


def read_contentsquare(spark: SparkSession, path: str, table: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One ContentSquare table below ``path``, of a range of days if one is given.

    Tables of which no columns are published are read with the columns their
    files have.
    """
    if table in schemas.CONTENTSQUARE_SIGNALS:
        rows = spark.read.parquet(f"{path}/{table}")
    else:
        rows = spark.read.schema(schemas.ddl(schemas.CONTENTSQUARE_TABLES[table])).parquet(f"{path}/{table}")
    return _between(rows, "time", start, end)
