"""As-of join: each row with the last state of its key that was known at its time.

Both streams are merged by time instead of being joined. They are cut by key and
time slice and sorted together once; the last state before a row is a running
value of that order. What a slice inherits from earlier ones is one small row
per key and slice, found over slices, not over rows, and sorted in ahead of the
slice. So a key with a large part of all rows is spread over its slices, and no
row meets all states of its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Order among rows of one time: what a slice inherits and states first, then rows that look for a state.
_STATE, _ROW = 0, 1


def _slice(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (seconds * 1_000_000)).cast("long")


def as_of(
    rows: DataFrame,
    states: DataFrame,
    keys: Sequence[str],
    ts: str,
    state_ts: str,
    tie: str,
    values: Sequence[str],
    prefix: str = "last_",
    slice_seconds: int = 86_400,
) -> DataFrame:
    """``rows`` with ``values`` of the latest of ``states`` at or before ``ts``, named with ``prefix``.

    Of states at one time the one with the largest ``tie`` counts. Rows whose key
    or time is NULL, and rows before the first state, get NULLs; states without
    key or time are in force nowhere. Every row comes out once, repeated ones too.
    Other columns of ``states`` are not read, so equal names do not clash.
    """
    value = F.struct(*[F.col(name).alias(f"{prefix}{name}") for name in values])
    keyed = lambda df: F.struct(*[F.col(k) for k in keys])
    whole = lambda: F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 0
    known = states.filter(whole() & F.col(state_ts).isNotNull()).select(
        keyed(states).alias("_key"), _slice(state_ts, slice_seconds).alias("_slice"),
        F.col(state_ts).alias("_at"), F.col(tie).alias("_tie"), value.alias("_state"),
    )
    found = whole() & F.col(ts).isNotNull()
    # A row that can have no state needs no neighbours: it is dealt out by its own content.
    alone = F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))])
    asking = rows.withColumns({
        "_key": F.when(found, keyed(rows)),
        "_slice": F.when(found, _slice(ts, slice_seconds)).otherwise(alone),
        "_at": F.when(found, F.col(ts)),
    })
    # The last state of each slice that has one, and the slices in which rows ask: small rows, combined before their shuffle.
    last = known.groupBy("_key", "_slice").agg(F.max(F.struct("_at", "_tie", "_state")).alias("_last"))
    wanted = asking.filter(F.col("_key").isNotNull()).select("_key", "_slice").distinct()
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = (
        last.withColumn("_asked", F.lit(False))
        .unionByName(wanted.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
        .groupBy("_key", "_slice").agg(F.max("_last").alias("_last"), F.max("_asked").alias("_asked"))
        .withColumn("_state", F.last("_last", ignorenulls=True).over(before)["_state"])
        .filter(F.col("_asked") & F.col("_state").isNotNull())
        .select("_key", "_slice", "_state")
    )
    merged = (
        asking.withColumn("_side", F.lit(_ROW))
        .unionByName(known.withColumn("_side", F.lit(_STATE)), allowMissingColumns=True)
        # Without a time it comes first.
        .unionByName(inherited.withColumn("_side", F.lit(_STATE)), allowMissingColumns=True)
    )
    ordered = Window.partitionBy("_key", "_slice").orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = merged.withColumn("_state", F.when(F.col("_key").isNotNull(), F.last("_state", ignorenulls=True).over(ordered))).filter(F.col("_side") == _ROW)
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col("_state")[f"{prefix}{name}"].alias(f"{prefix}{name}") for name in values])
