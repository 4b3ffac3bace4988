"""Tables kept in the shared folder, and input columns by name."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.session import work_path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The lineage ends there: a lost executor costs no more than the tasks that
    read it. A join with the table has a plain exchange on this side, so that
    adaptive execution can split heavy keys of the other one.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(left: Column, right: Column) -> Column:
    """Equal, or both null."""
    return left.eqNullSafe(right)


def tasks(df: DataFrame) -> int:
    """How many tasks a shuffle of the session has."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def importable(df: DataFrame) -> DataFrame:
    """Let Python workers on this machine import the package, wherever the session was started.

    On a cluster the package is installed or sent with ``--py-files``, as usual.
    """
    root = str(Path(__file__).resolve().parents[2])
    settings = df.sparkSession.sparkContext.environment
    known = settings.get("PYTHONPATH", "")
    if root not in known.split(":"):
        settings["PYTHONPATH"] = ":".join(filter(None, [known, root]))
    return df


def text_rows(docs: DataFrame, *more: str) -> DataFrame:
    """Only what an operator reads: the id, the text and named columns."""
    return importable(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def unused(df: DataFrame, name: str) -> str:
    """The name, or one like it, that no column of the table has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
