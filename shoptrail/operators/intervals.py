"""Interval join: each event with the intervals of its key that hold its time.

Time is cut into bins and an interval stands in every bin it overlaps, so the
join is an equality on key and bin, which shuffles and splits heavy keys like any
other. An event has one bin per size and an interval one size, so no pair is
found twice. An interval goes to the smallest of several bin sizes in which it
has few bins: a view of a minute lies in one or two short bins, one of a week
in a few long ones, and neither makes many rows. Rows of both sides are
shuffled once per bin, so few bins count more than narrow ones: what shares a
bin without meeting is left out inside the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bin sizes in seconds: 5 minutes, an hour, a day, 30 days. Intervals longer than all take the last.
BINS = (300, 3_600, 86_400, 2_592_000)
MOST_BINS = 4


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _bin(ts: Column, seconds: Column) -> Column:
    return F.floor(_micros(ts) / (seconds * 1_000_000)).cast("long")


def in_bins(intervals: DataFrame, keys: Sequence[str], start: str, end: str, values: Sequence[str], bins: Sequence[int] = BINS) -> DataFrame:
    """A row for each interval and bin it overlaps, with what ``holding`` needs of it."""
    length = _micros(F.col(end)) - _micros(F.col(start))
    last = len(bins) - 1
    # A bin's number tells its size too: the sizes take turns.
    which, size = F.lit(last), F.lit(bins[last]).cast("long")
    for i in range(last - 1, -1, -1):
        short = length <= (MOST_BINS - 1) * bins[i] * 1_000_000
        which, size = F.when(short, i).otherwise(which), F.when(short, F.lit(bins[i]).cast("long")).otherwise(size)
    # Bounds that are asked for as values are not carried twice.
    since, until = start if start in values else "_start", end if end in values else "_end"
    bounds = [F.col(c).alias(name) for c, name in ((start, "_start"), (end, "_end")) if c not in values]
    spans = intervals.filter(F.col(start) < F.col(end)).select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *bounds, *values, size.alias("_size"), which.alias("_which"),
    )
    # The end itself is outside: the last bin is that of the microsecond before.
    final = F.floor((_micros(F.col(until)) - 1) / (F.col("_size") * 1_000_000)).cast("long")
    bin_ = F.explode(F.sequence(_bin(F.col(since), F.col("_size")), final))
    return spans.withColumn("_bin", bin_).withColumn("_bin", F.col("_bin") * len(bins) + F.col("_which")).drop("_size", "_which")


def holding(
    events: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    ts: str,
    start: str,
    end: str,
    values: Sequence[str],
    bins: Sequence[int] = BINS,
) -> DataFrame:
    """A row for each event and interval with equal ``keys`` and ``start`` <= ``ts`` < ``end``: the event and the interval's ``values``.

    Events outside all intervals, events or intervals without key or time, and
    intervals that end at or before their start have no row. ``values`` must not
    be names of ``events``; other columns of ``intervals`` are not read.
    """
    clash = sorted(set(values) & set(events.columns))
    if clash:
        raise ValueError(f"both sides have {clash}")
    spans = in_bins(intervals, keys, start, end, values, bins)
    since, until = start if start in values else "_start", end if end in values else "_end"
    numbers = [_bin(F.col(ts), F.lit(b).cast("long")) * len(bins) + i for i, b in enumerate(bins)]
    points = events.filter(F.col(ts).isNotNull()).withColumn("_at_bin", F.explode(F.array(*numbers)))
    on = F.col("_at_bin") == F.col("_bin")
    for i, k in enumerate(keys):
        on = on & (points[k] == F.col(f"_key{i}"))
    met = points.join(spans, on & (F.col(since) <= points[ts]) & (points[ts] < F.col(until)))
    return met.select(*[points[f"`{c}`"] for c in events.columns], *values)
