"""Numbers, dates and picks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(column: str | Column) -> Column:
    """A whole number out of text, NULL if the text is none (SCA-21)."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("bigint")


def real(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("double")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that gives NULL for a zero or missing divisor (SCA-22)."""
    top = F.col(numerator) if isinstance(numerator, str) else numerator
    bottom = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def day_from_text(column: str) -> Column:
    """``YYYYMMDD`` to a date (SCA-1)."""
    return F.to_date(F.col(column), "yyyyMMdd")


def whole_units(unit: str, start: str | Column, end: str | Column) -> Column:
    """Completed units between two timestamps (SCA-4)."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff(unit, start, end)


def first_known(value: str, ts: str = "event_ts") -> Column:
    """The earliest known value of a group (AGG-9).

    An aggregate over a small (time, value) pair, so it is combined before the
    shuffle; equal times are settled by the value itself.
    """
    pair = f"named_struct('at', `{ts}`, 'value', `{value}`)"
    return F.expr(f"min(if(`{value}` is not null, {pair}, null)).value")
