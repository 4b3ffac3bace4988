"""One schema out of several sources (PRJ-3, SET-1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from shoptrail import schemas


def conform(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Exactly ``fields``: known columns are cast, missing ones are typed NULLs."""
    known = set(df.columns)
    return df.selectExpr(
        *[
            f"cast({f'`{name}`' if name in known else 'null'} as {kind}) as `{name}`"
            for name, kind in fields.items()
        ]
    )


def union_sources(spark: SparkSession, frames: list[DataFrame], fields: dict[str, str]) -> DataFrame:
    """All rows of all sources; without any source an empty frame of that schema."""
    if not frames:
        return spark.createDataFrame([], schemas.ddl(fields))
    return reduce(DataFrame.unionByName, [conform(frame, fields) for frame in frames])
