"""Sessions of events that name none: a user's events until a pause.

A session window sorts all events of a key in one task. Here events are first
grouped by key, day and window, which makes one small row for each run of events
within a day; runs of a key are then merged across the ends of days. What a task
sorts together is a key's day, and after that a key's runs, whatever its history.
Measures are merged the same way, so they are the same as over the whole session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _measures(conditions: dict[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("events"), *[F.count_if(c).alias(name) for name, c in conditions.items()]]


def gap_sessions(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap_seconds: int = 1800,
    counts: dict[str, Column] | None = None,
    slice_seconds: int = 86_400,
) -> DataFrame:
    """``keys``, session_number (from 1, in order of time), session_start_ts, session_end_ts, events and ``counts``.

    Events at most ``gap_seconds`` apart are in one session, as in Spark's session windows,
    which keep a pause of exactly that length inside. ``counts`` names conditions whose events are
    counted. Events without a time are left out; NULL keys are equal, as in any group.
    """
    counts = counts or {}
    gap = gap_seconds * 1_000_000
    timed = events.filter(F.col(ts).isNotNull()).withColumns({
        "_at": F.unix_micros(F.col(ts).cast("timestamp")),
        "_slice": F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (slice_seconds * 1_000_000)).cast("long"),
    })
    runs = timed.groupBy(*keys, "_slice", F.session_window(F.col(ts).cast("timestamp"), f"{gap_seconds} seconds").alias("_window")).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), *_measures(counts)
    )
    by_time = Window.partitionBy(*keys).orderBy("_first")
    begins = F.coalesce(F.col("_first") - F.lag("_last").over(by_time) > gap, F.lit(True))
    numbered = runs.withColumn("session_number", F.sum(begins.cast("long")).over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*keys, "session_number").agg(
        F.timestamp_micros(F.min("_first")).alias("session_start_ts"),
        F.timestamp_micros(F.max("_last")).alias("session_end_ts"),
        *[F.sum(name).cast("long").alias(name) for name in ("events", *counts)],
    )


def gap_session_stream(events: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int = 1800, delay: str = "2 days", counts: dict[str, Column] | None = None) -> DataFrame:
    """The same sessions of a stream, each given once when the watermark has passed its end. They have no number, as later ones may fill a gap."""
    window = F.session_window(F.col(ts), f"{gap_seconds} seconds").alias("_window")
    found = events.withWatermark(ts, delay).groupBy(*keys, window).agg(F.max(ts).alias("session_end_ts"), *_measures(counts or {}))
    return found.withColumn("session_start_ts", F.col("_window.start")).drop("_window")
