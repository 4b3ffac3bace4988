"""Surrogate keys (SCA-24)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what stands for NULL inside a hashed key, so that keys agree
# with tables whose keys were made by the common surrogate-key convention.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """MD5 over the columns' text, joined by ``-``.

    Give whole numbers, dates and text only: the text form of a timestamp or a
    double is not the same in every engine.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_TOKEN)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))
