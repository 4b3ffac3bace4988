"""Output tables: Parquet folders, one per table, one sub-folder per day (SNK-1..7)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

LAYERS = ("staging", "integration", "warehouse", "marts")
DAY = "event_date"


def table_path(root: str, layer: str, name: str) -> str:
    """One output namespace per layer (SNK-7)."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if it was never written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _laid_out(
    df: DataFrame, cluster: Sequence[str], gathered: bool = False, shape: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Rows gathered by day, sorted for row-group skipping (SNK-4).

    ``rebalance`` lets adaptive execution cut a large day over several tasks
    and files and put small days together, whatever the days' sizes are. Rows
    ``gathered`` already, as a table by day is read, are only sorted: a task
    reads files of few days. ``shape`` is a projection made after that, so
    that what it adds is not shuffled.
    """
    rows = df if gathered else df.hint("rebalance", DAY)
    if shape is not None:
        rows = shape(rows)
    return rows.sortWithinPartitions(DAY, *[c for c in cluster if c in rows.columns])


def write_days(
    df: DataFrame, path: str, cluster: Sequence[str] = (), test: Callable[[DataFrame], None] | None = None,
    gathered: bool = False, shape: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write the whole table anew, one folder per day (SNK-2, SNK-3); ``test`` sees it before it takes the old one's place."""
    _swap(df.sparkSession, path, lambda beside: _write_beside(_laid_out(df, cluster, gathered, shape), beside, test))


def _write_beside(rows: DataFrame, beside: str, test: Callable[[DataFrame], None] | None) -> None:
    rows.write.partitionBy(DAY).parquet(beside)
    if test is not None:
        test(rows.sparkSession.read.schema(rows.schema).parquet(beside))


def replace_days(df: DataFrame, path: str, cluster: Sequence[str] = ()) -> None:
    """Replace the days ``df`` has rows of, leave all others as they are."""
    (
        _laid_out(df, cluster).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY).parquet(path)
    )


def exchange_days(
    df: DataFrame, path: str, days: Iterable, cluster: Sequence[str] = (), test: Callable[[DataFrame], None] | None = None
) -> None:
    """Let ``df`` be the content of ``days``, which hold all its rows; those it has no rows of go.

    Written once, beside the table and by day; what passed ``test`` there takes the days' places by name. ``df`` may
    read the table itself. Old days are deleted last: a run that dies before leaves them beside the table.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    beside, old = f"{path}__new_{mark}", f"{path}__old_{mark}"
    try:
        _write_beside(_laid_out(df, cluster), beside, test)
    except BaseException:
        remove(spark, [beside])
        raise
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder(old))
    for day in days:
        live, fresh = folder(_day_path(path, day)), folder(_day_path(beside, day))
        if files.exists(live) and not files.rename(live, folder(_day_path(old, day))):
            raise OSError(f"cannot move {live} aside")
        if files.exists(fresh) and not files.rename(fresh, live):
            raise OSError(f"cannot publish {live}")
    remove(spark, [beside, old])
    spark.catalog.refreshByPath(path)


def write_whole(df: DataFrame, path: str) -> None:
    """Full rebuild of a table without days, such as the user dimension (SNK-2)."""
    _swap(df.sparkSession, path, lambda beside: df.write.parquet(beside))


def _swap(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write beside the table, then take its name: the old content is deleted last.

    A run that dies while writing leaves the table as it was, one that dies between the two renames
    leaves the old content beside it, under a name that tells so.
    """
    mark = uuid.uuid4().hex
    beside, old = f"{path}__new_{mark}", f"{path}__old_{mark}"
    try:
        write(beside)
    except BaseException:
        remove(spark, [beside])
        raise
    source, live, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path, old))
    files = live.getFileSystem(spark._jsc.hadoopConfiguration())
    there = files.exists(live)
    if there and not files.rename(live, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(source, live):
        if there:
            files.rename(aside, live)
        raise OSError(f"cannot publish {path}")
    if there:
        files.delete(aside, True)
    spark.catalog.refreshByPath(path)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders this library wrote, through the shared file system."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def _day_path(path: str, day) -> str:
    return f"{path}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def remove_days(spark: SparkSession, path: str, days: Iterable) -> None:
    remove(spark, [_day_path(path, day) for day in days])
