"""Users against each other: quintiles of recency, frequency and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.operators.ranks import ranked


def rfm_quintiles(users: DataFrame) -> DataFrame:
    """One row per user with its fifth of all users (5 the best) and its percent rank in each measure.

    Recency: days since the last visit, fewest best. Revenue is taken to the cent, so that the
    order of a sum decides nothing; equal values are dealt over fifths by the user's key.
    """
    slim = users.select("user_pk", "days_since_last_visit", "total_sessions", F.round("total_revenue", 2).alias("total_revenue"))
    for value, name, descending in (("days_since_last_visit", "recency", True), ("total_sessions", "frequency", False), ("total_revenue", "monetary", False)):
        slim = ranked(slim, value, "user_pk", descending, 5, ("_row", "_rank", f"{name}_percent_rank", f"{name}_quintile")).drop("_row", "_rank")
    code = F.concat(*[F.col(f"{name}_quintile").cast("string") for name in ("recency", "frequency", "monetary")])
    return slim.withColumn("rfm", code)
