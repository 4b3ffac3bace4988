"""Navigation inside a session: next, previous, position, count (WIN-1..4).

A window function sorts one whole group in one task. Session groups are small,
but not all of them: views without a session id form one group per user, and a
crawler can own a large part of all views. So every group is cut by the hour of
its views, whatever its size: a window numbers the views of one hour, and the
hours of a group, one small row each, are stitched together. What one task must
hold together is a group's views of an hour, not its history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The slices of views without a time come before all others, as in an ascending sort.
_NO_TIME = -(1 << 62)
_ADDED = ("next_page_ts", "previous_page_location", "page_number_in_session", "total_pages_in_session")


def _untimed_slice(views: DataFrame, tie: str) -> Column:
    """Views without a time are ordered by the tie alone: by its first two bytes they fall into slices in that order."""
    if dict(views.dtypes)[tie] != "string":
        return F.lit(_NO_TIME)
    lead = F.rpad(F.hex(F.substring(F.col(tie).cast("binary"), 1, 2)), 4, "0")
    return F.lit(_NO_TIME) + F.coalesce(F.conv(lead, 16, 10).cast("long") + 1, F.lit(0))


def page_flow(
    views: DataFrame,
    keys: Sequence[str] = ("source", "user_fk", "ga_session_id"),
    ts: str = "pageview_ts",
    tie: str = "pageview_pk",
    place: str = "page_location",
    slice_seconds: int = 3600,
) -> DataFrame:
    """Add next_page_ts, previous_page_location, page_number_in_session and
    total_pages_in_session, in the order of (``ts``, ``tie``) within ``keys``.

    NULL keys count as equal, as in any window; views without a time come first.
    """
    # A struct of the keys is never NULL itself, and equal structs may hold NULLs: a plain
    # equality joins them, on the partitioning that the window has already.
    hour = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (slice_seconds * 1_000_000)).cast("long")
    sliced = views.withColumns({"_group": F.struct(*keys), "_slice": F.coalesce(hour, _untimed_slice(views, tie))})
    # The ends of each slice, one small row each, straight from the input: combined before their shuffle.
    place_in_order = F.struct(F.col(ts).alias("at"), F.col(tie).alias("tie"), F.col(place).alias("place"))
    ends = sliced.select("_group", "_slice", place_in_order.alias("_view")).groupBy("_group", "_slice").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_view")["at"].alias("_first_ts"), F.max("_view")["place"].alias("_last_place")
    )
    across = Window.partitionBy("_group").orderBy("_slice")
    stitched = ends.select(
        F.col("_group").alias("_g"),
        F.col("_slice").alias("_s"),
        "_size",
        F.coalesce(F.sum("_size").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy("_group")).alias("_total"),
        F.lead("_first_ts").over(across).alias("_slice_next"),
        F.lag("_last_place").over(across).alias("_slice_previous"),
    )
    # Joined before the window: rows are shuffled once, by group and slice, and the window finds them so. Every
    # view has its slice's row and only one; as a left join Spark leaves it out for readers of other columns.
    ordered = Window.partitionBy("_group", "_slice").orderBy(ts, tie)
    joined = sliced.join(stitched, (F.col("_group") == F.col("_g")) & (F.col("_slice") == F.col("_s")), "left").withColumns({
        "_next": F.lead(ts).over(ordered),
        "_previous": F.lag(place).over(ordered),
        "_number": F.row_number().over(ordered),
    })
    first, last = F.col("_number") == 1, F.col("_number") == F.col("_size")
    values = (
        F.when(last, F.col("_slice_next")).otherwise(F.col("_next")),
        F.when(first, F.col("_slice_previous")).otherwise(F.col("_previous")),
        (F.col("_before") + F.col("_number")).cast("bigint"),
        F.col("_total").cast("bigint"),
    )
    return joined.select(*[c for c in views.columns if c not in _ADDED], *[v.alias(n) for v, n in zip(values, _ADDED, strict=True)])
