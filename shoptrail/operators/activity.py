"""Rolling sums and rolling distinct users per day.

A distinct count over a moving frame cannot be added up from days. Here a user's
active days become spells: each active day covers itself and the days after it in
the frame, and only the first day of a spell and the day after its end change the
count. These changes are summed per day, and a running sum over days is the count.
Every user is handled with its own days alone, and days are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def calendar(rows: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """All days of each group from its first to its last."""
    ends = rows.filter(F.col(day).isNotNull()).groupBy(*by).agg(F.min(day).alias("_from"), F.max(day).alias("_to"))
    return ends.select(*by, F.explode(F.sequence("_from", "_to")).alias(day))


def rolling_activity(rows: DataFrame, by: Sequence[str], day: str, who: str, counted: str = "rows", days: Sequence[int] = (7, 28)) -> DataFrame:
    """Per group and calendar day: ``counted`` and users of that day, and of the last n days, as ``<name>_<n>d``.

    Days without rows are there with what their frames hold. Rows without a day are left out;
    rows without a user count, but name no user. NULL groups are a group.
    """
    timed = rows.filter(F.col(day).isNotNull())
    daily = timed.groupBy(*by, day).agg(F.count(F.lit(1)).alias(counted))
    active = timed.filter(F.col(who).isNotNull()).select(*by, who, day).distinct()
    own = Window.partitionBy(*by, who).orderBy(day)
    spells = active.withColumns({"_before": F.lag(day).over(own), "_after": F.lead(day).over(own)})
    changes = []
    for n in (1, *days):
        # A spell begins where the day before is too long ago, and ends n days after its last active day.
        begins = F.when(F.col("_before").isNull() | (F.date_add("_before", n) <= F.col(day)), F.col(day))
        ends = F.when(F.col("_after").isNull() | (F.date_add(day, n) <= F.col("_after")), F.date_add(day, n))
        changes += [F.struct(F.lit(n).alias("n"), begins.alias("on"), F.lit(1).alias("step")), F.struct(F.lit(n).alias("n"), ends.alias("on"), F.lit(-1).alias("step"))]
    steps = spells.select(*by, F.explode(F.array(*changes)).alias("c")).filter("c.on is not null")
    per_day = steps.groupBy(*by, F.col("c.on").alias(day)).agg(*[F.sum(F.when(F.col("c.n") == n, F.col("c.step")).otherwise(0)).alias(f"_step_{n}") for n in (1, *days)])

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        other = right.select(*[F.col(c).alias(f"_r_{c}") for c in (*by, day)], *[c for c in right.columns if c not in (*by, day)])
        on = F.col(day) == F.col(f"_r_{day}")
        for c in by:
            on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        return left.join(other, on, how).drop(*[f"_r_{c}" for c in (*by, day)])

    every = joined(joined(calendar(timed, by, day), daily, "left"), per_day, "left").na.fill(0, [counted, *[f"_step_{n}" for n in (1, *days)]])
    ordered = Window.partitionBy(*by).orderBy(F.unix_date(day))
    running = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return every.select(
        *by, day, counted, F.sum("_step_1").over(running).cast("long").alias("users"),
        *[F.sum(counted).over(ordered.rangeBetween(1 - n, 0)).cast("long").alias(f"{counted}_{n}d") for n in days],
        *[F.sum(f"_step_{n}").over(running).cast("long").alias(f"users_{n}d") for n in days],
    )
