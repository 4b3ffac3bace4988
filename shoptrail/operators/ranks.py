"""Ranks over all rows of a table, without a window over all rows.

A window without a partition key sorts the whole table in one task. Here rows
are dealt out by ranges of the order, numbered within their range, and lifted by
the rows of the ranges before, of which the driver sees a few numbers per range.
The order ends in a key that tells rows apart, so a value that very many rows
share is cut over ranges like any other; its rank is that of its first row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.session import work_path


def ranked(
    df: DataFrame,
    value: str,
    key: str,
    descending: bool = False,
    tiles: int | None = None,
    names: Sequence[str] = ("row_number", "rank", "percent_rank", "tile"),
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with row_number, rank, percent_rank and, if ``tiles`` is given, tile of ``value``, as SQL's window functions name them.

    Rows of equal value are numbered by ``key``, which must tell rows apart for the numbers to be
    the same on each run; their rank is equal. NULL values come first, as in any ascending order,
    or last if ``descending``. The numbered rows are written to the work folder once, so that ranges stay as they are.
    """
    spark = df.sparkSession
    by_value = F.desc(value) if descending else F.asc(value)
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, by_value, F.asc(key)).withColumn("_range", F.spark_partition_id())
    path = work_path(spark, "ranked")
    within = Window.partitionBy("_range").orderBy(by_value, F.asc(key))
    # The rows of a range lie in its task already, but Spark cannot know it: written first, numbered after.
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)
    # Per range: how many rows, its first and last value, and how many of its rows come before the last value.
    # NULL is a value of its own here, so values are wrapped.
    wrapped = F.struct(F.col(value).alias("v"))
    local = rows.select("_range", wrapped.alias("w")).groupBy("_range", "w").agg(F.count(F.lit(1)).alias("n"))
    order = F.max("w") if not descending else F.min("w")
    other = F.min("w") if not descending else F.max("w")
    ends = local.groupBy("_range").agg(F.sum("n").alias("n"), other.alias("first"), order.alias("last"))
    tail = local.join(ends.select(F.col("_range").alias("r"), "last"), (F.col("_range") == F.col("r")) & F.col("w").eqNullSafe(F.col("last"))).select("_range", F.col("n").alias("at_end"))
    found = sorted(ends.join(tail, "_range").collect(), key=lambda r: r["_range"])  # one row per range

    before, lifted, total = 0, [], sum(r["n"] for r in found)
    carried, carried_rank = None, 0  # the last value so far, and its rank
    for r in found:
        continues = carried is not None and r["first"] == carried
        lifted.append((r["_range"], before, carried_rank if continues else None))
        if not (continues and r["first"] == r["last"]):
            carried_rank = before + r["n"] - r["at_end"] + 1
        carried = r["last"]
        before += r["n"]
    # Two lookups by the range's number: literal arrays, found by place, in place of a join.
    table = {place: values for place, *values in lifted}
    size = max(table, default=0) + 1
    lift = F.array(*[F.lit(table.get(i, (0, None))[0]).cast("long") for i in range(size)])
    first_rank = F.array(*[F.lit(table.get(i, (0, None))[1]).cast("long") for i in range(size)])

    number, rank, share, tile = names
    out = rows.withColumns({
        number: (lift[F.col("_range")] + F.row_number().over(within)).cast("long"),
        rank: F.rank().over(Window.partitionBy("_range").orderBy(by_value)).cast("long"),
    })
    # A value that began in an earlier range has the rank it got there.
    inherited = first_rank[F.col("_range")]
    out = out.withColumn(rank, F.when((F.col(rank) == 1) & inherited.isNotNull(), inherited.cast("long")).otherwise(lift[F.col("_range")] + F.col(rank)).cast("long"))
    out = out.withColumn(share, F.when(F.lit(total) > 1, (F.col(rank) - 1) / F.lit(float(max(total - 1, 1)))).otherwise(F.lit(0.0)))
    if tiles:
        out = out.withColumn(tile, _tile(F.col(number), total, tiles))
    return out.drop("_range")


def _tile(number: Column, total: int, tiles: int) -> Column:
    """The first ``total % tiles`` tiles have one row more than the others."""
    size, longer = divmod(total, tiles)
    edge = longer * (size + 1)
    late = F.floor((number - 1 - edge) / max(size, 1)) + longer + 1
    return F.when(number <= edge, F.floor((number - 1) / (size + 1)) + 1).otherwise(late).cast("long")


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """The distinct values of ``key`` numbered from 0 without gaps, in order; NULL has no number."""
    keys = df.filter(F.col(key).isNotNull()).select(key).distinct()
    out = ranked(keys, key, key, names=(name, "_rank", "_share", "_tile"))
    return out.select(key, (F.col(name) - 1).alias(name))
