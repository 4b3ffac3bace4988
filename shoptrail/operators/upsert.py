"""Incremental loading: marks, one row per key, merge by key (INC-1..5)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "event_date"


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on all keys; NULL equals NULL, so a repeated load changes nothing."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


# ------------------------------------------------------------ high-water marks
def high_water_marks(target: DataFrame | None) -> dict[str | None, dt.date]:
    """The last loaded day of each source (INC-1).

    A source that lags behind the others keeps a mark of its own. A table
    without ``source`` has one mark, under the key None. Reads at most the
    source column; the answer has one row per source.
    """
    if target is None:
        return {}
    source = F.col("source") if "source" in target.columns else F.lit(None).cast("string")
    marks = target.select(source.alias("source"), DAY).groupBy("source").agg(F.max(DAY).alias("mark"))
    return {row["source"]: row["mark"] for row in marks.collect() if row["mark"] is not None}


def newer_than(rows: DataFrame, marks: dict[str | None, dt.date], lookback_days: int = 0) -> DataFrame:
    """Rows after their source's mark, with the last ``lookback_days`` again (INC-3).

    Without a mark nothing is filtered. The marks are literals, so they prune
    day folders when the plan is made.
    """
    if not marks:
        return rows
    first = {s: mark + dt.timedelta(days=1 - lookback_days) for s, mark in marks.items()}
    # What holds for every source comes as a condition on the day alone, which
    # is all that a day-partitioned scan can use.
    if "source" not in rows.columns:
        return rows.filter(F.col(DAY) >= F.lit(min(first.values())))
    fresh = F.lit(False)
    for source, day in first.items():
        fresh = fresh | (F.col("source").eqNullSafe(F.lit(source)) & (F.col(DAY) >= F.lit(day)))
    known = [s for s in first if s is not None]
    unseen = ~F.col("source").isin(known) if known else F.lit(True)
    # A row without source is compared with the mark of such rows, if there is one.
    unseen = F.coalesce(unseen, F.lit(True)) & (F.col("source").isNotNull() | F.lit(None not in first))
    return rows.filter(fresh | unseen)


# ----------------------------------------------------------------- one per key
def one_per_key(rows: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the latest by ``newest``, then by content (INC-4).

    An aggregate, not a ranking window: copies are reduced before the shuffle,
    so a row delivered very many times does not end up in one task.
    """
    others = [c for c in rows.columns if c not in keys]
    order = F.struct(
        *[F.col(c).alias(f"order_{i}") for i, c in enumerate(newest)], F.xxhash64(*rows.columns).alias("content")
    )
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), order).alias("row"))
        .select(*[c if c in keys else F.col(f"row.`{c}`").alias(c) for c in rows.columns])
    )


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The hashes of keys that occur more than once, and by chance of a few others; reads the key columns only."""
    return rows.groupBy(F.xxhash64(*keys).alias("key_hash")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("key_hash")


def one_of_repeated(rows: DataFrame, repeated: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """``one_per_key`` where only the rows of ``repeated_keys`` are compared; all others stay as they are."""
    same = F.xxhash64(*[rows[k] for k in keys]) == repeated["key_hash"]
    return rows.join(repeated, same, "left_anti").unionByName(one_per_key(rows.join(repeated, same, "left_semi"), keys, newest))


# ----------------------------------------------------------------------- merge
@dataclass(frozen=True)
class Merge:
    """The new content of the days an upsert touches."""

    rows: DataFrame
    days: tuple[dt.date | None, ...]


def _days(frame: DataFrame) -> set[dt.date]:
    return {row[0] for row in frame.select(DAY).distinct().collect()}


def merge_by_key(
    target: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    key_fixes_day: bool = False,
    drop_before: Column | None = None,
) -> Merge:
    """New rows replace target rows of the same key, all others stay (INC-2).

    Only touched days are read in full: the new rows' days and, as a key may
    come again under another day, the days where their keys are now. The
    second look reads the key columns only and is skipped where the key
    settles the day. ``drop_before`` names target rows to leave out whether or
    not they come again (a replaced day).
    """
    days = _days(new)
    if not key_fixes_day and DAY not in keys:
        held = target.select(DAY, *keys)
        wanted = new.select(*keys)
        days |= _days(held.join(wanted, same_keys(held, wanted, keys), "left_semi"))
    if drop_before is not None:
        days |= _days(target.filter(drop_before))
    known = sorted(day for day in days if day is not None)
    on_day = F.col(DAY).isin(known)
    if None in days:  # rows without a day are a day of their own
        on_day = on_day | F.col(DAY).isNull()
    touched = target.filter(on_day)
    if drop_before is not None:
        touched = touched.filter(~F.coalesce(drop_before, F.lit(False)))
    replaced = new.select(*keys)
    kept = touched.join(replaced, same_keys(touched, replaced, keys), "left_anti")
    return Merge(kept.unionByName(new.select(*target.columns)), (*known, *([None] if None in days else [])))


def rows_of_groups(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows of the groups that got new rows (INC-5).

    A session that runs over the load boundary is numbered again as a whole.
    """
    groups = new.select(*keys).distinct()
    return target.join(groups, same_keys(target, groups, keys), "left_semi")
