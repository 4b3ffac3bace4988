"""Exact distinct counts over all combinations of dimensions, by bitmaps.

Counting distinct ids in a cube would copy every event once per combination and
shuffle the copies with their ids. Here ids get dense numbers, and each full
combination of dimensions gets bitmaps of them: a bit per id, 32768 to a bitmap,
one bitmap for each thing counted. Only these reduced rows are copied per
combination; their bitmaps are united, and ones are counted at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.operators.ranks import numbered
from shoptrail.session import work_path


def distinct_cube(rows: DataFrame, dimensions: Sequence[str], who: str, counted: dict[str, Column]) -> DataFrame:
    """For each combination of ``dimensions`` or of all values of some: how many distinct ``who`` have rows that meet each condition.

    A dimension that is summed over is NULL and has its bit set in ``grouping_id``, the first
    dimension the highest; a NULL among its values is a value. Rows without ``who`` count nobody,
    yet keep their combination.
    """
    spark = rows.sparkSession
    # One row per combination and id, with all conditions it ever met: combined before the shuffle.
    met = rows.groupBy(*dimensions, who).agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(name) for name, c in counted.items()])
    path = work_path(spark, "cube")
    met.write.parquet(path)
    met = spark.read.schema(met.schema).parquet(path)
    numbers = numbered(met, who, "_number").withColumnRenamed(who, "_who")
    placed = met.join(numbers, F.col(who) == F.col("_who"), "left")
    bit = F.bitmap_bit_position(F.col("_number") + 1)
    reduced = placed.groupBy(*dimensions, F.bitmap_bucket_number(F.col("_number") + 1).alias("_bucket")).agg(
        *[F.bitmap_construct_agg(F.when(F.col(name), bit)).alias(name) for name in counted]
    )
    sets = [[*some, "_bucket"] for n in range(len(dimensions) + 1) for some in combinations(dimensions, n)]
    united = reduced.groupingSets(sets, *dimensions, "_bucket").agg(
        F.grouping_id().alias("_grouping"), *[F.bitmap_or_agg(name).alias(name) for name in counted]
    )
    # The last bit of the grouping is the bucket's, which is never summed over.
    return united.groupBy(*dimensions, F.shiftright("_grouping", 1).cast("long").alias("grouping_id")).agg(
        *[F.sum(F.when(F.col("_bucket").isNotNull(), F.bitmap_count(name)).otherwise(0)).cast("long").alias(name) for name in counted]
    )
