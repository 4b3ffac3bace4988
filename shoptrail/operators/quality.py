"""Data tests as Spark jobs (DQ-1..14): one result row per test."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"


class GateError(Exception):
    """Tests of severity error failed; nothing was published."""


@dataclass(frozen=True)
class Check:
    """One test of one table.

    ``failing`` is a condition that is true for a failing row. ``keys`` makes
    it a uniqueness test, ``parent`` a test for keys missing in another table.
    """

    kind: str
    column: str
    failing: Column | None = None
    keys: tuple[str, ...] = ()
    parent: tuple[DataFrame, str] | None = field(default=None, compare=False)
    severity: str = ERROR


# ------------------------------------------------------------------- the tests
def not_null(column: str, severity: str = ERROR) -> Check:
    """DQ-2."""
    return Check("not_null", column, failing=F.col(column).isNull(), severity=severity)


def not_null_where(column: str, where: Column, severity: str = ERROR) -> Check:
    """DQ-5."""
    return Check("not_null_where", column, failing=F.col(column).isNull() & where, severity=severity)


def accepted_values(column: str, values: Sequence, severity: str = ERROR) -> Check:
    """DQ-3; a missing value is not a wrong one."""
    return Check("accepted_values", column, failing=~F.col(column).isin(list(values)), severity=severity)


def expression_is_true(name: str, expression: Column, severity: str = ERROR) -> Check:
    """DQ-8; an unknown result does not fail."""
    return Check("expression_is_true", name, failing=~expression, severity=severity)


def unique(column: str, severity: str = ERROR) -> Check:
    """DQ-1; rows without a key are not counted."""
    return Check("unique", column, keys=(column,), severity=severity)


def unique_combination(columns: Sequence[str], severity: str = ERROR) -> Check:
    """DQ-7."""
    return Check("unique_combination_of_columns", "-".join(columns), keys=tuple(columns), severity=severity)


def not_constant(column: str, severity: str = ERROR) -> Check:
    """DQ-6."""
    return Check("not_constant", column, severity=severity)


def relationships(column: str, parent: DataFrame, parent_column: str, severity: str = ERROR) -> Check:
    """DQ-4 and JOI-6: keys that the parent table does not have."""
    return Check("relationships", column, parent=(parent, parent_column), severity=severity)


# -------------------------------------------------------------------- the runs
def run_checks(model: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All results of one table.

    Every row-by-row test of the table is answered by one scan. Uniqueness and
    relationship tests need a shuffle on their key each, combined before it.
    """
    checks = list(checks)
    one_scan = [c for c in checks if not c.keys and c.parent is None]
    parts = []
    if one_scan:
        parts.append(_one_scan(df, one_scan))
    parts += [_duplicates(df, c) for c in checks if c.keys]
    parts += [_orphans(df, c) for c in checks if c.parent is not None]
    results = reduce(DataFrame.unionByName, parts)
    status = (
        F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == WARN, "warn")
        .otherwise("fail")
    )
    return results.select(
        F.concat_ws(".", F.lit(model), F.col("column"), F.col("kind")).alias("test_id"),
        F.lit(model).alias("model"),
        "column", "severity", "failures", "total", status.alias("status"), "sample",
    )


def _result(check: Check, failures: Column, total: Column, sample: Column) -> Column:
    return F.struct(
        F.lit(check.column).alias("column"),
        F.lit(check.kind).alias("kind"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(failures.cast("bigint"), F.lit(0)).alias("failures"),
        total.cast("bigint").alias("total"),
        sample.cast("string").alias("sample"),
    )


def _one_scan(df: DataFrame, checks: list[Check]) -> DataFrame:
    total = F.count(F.lit(1))
    results = []
    for check in checks:
        if check.kind == "not_constant":
            value = F.col(check.column)
            constant = (F.min(value) == F.max(value)).cast("bigint")
            results.append(_result(check, constant, total, F.when(constant == 1, F.min(value).cast("string"))))
            continue
        sample = F.lit(None)
        if check.kind == "accepted_values":
            sample = F.min(F.when(check.failing, F.col(check.column).cast("string")))
        results.append(_result(check, F.count_if(check.failing), total, sample))
    return df.agg(F.array(*results).alias("results")).select(F.explode("results").alias("r")).select("r.*")


def _duplicates(df: DataFrame, check: Check) -> DataFrame:
    """Keys that occur more than once; NULL keys do not count as equal."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in check.keys])
    counted = df.groupBy(*check.keys).agg(F.count(F.lit(1)).alias("_copies"))
    twice = whole & (F.col("_copies") > 1)
    key = F.concat_ws("-", *[F.col(k).cast("string") for k in check.keys])
    result = _result(check, F.count_if(twice), F.coalesce(F.sum("_copies"), F.lit(0)), F.min(F.when(twice, key)))
    return counted.agg(result.alias("r")).select("r.*")


def _orphans(df: DataFrame, check: Check) -> DataFrame:
    """Rows whose key the parent lacks.

    Both sides are reduced to their distinct keys first, so neither a hot key
    nor the row count of the child reaches the join.
    """
    parent, parent_column = check.parent
    have = parent.select(F.col(parent_column).alias("key")).filter(F.col("key").isNotNull()).distinct()
    have = have.withColumn("found", F.lit(True))
    children = df.groupBy(F.col(check.column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    lost = F.col("key").isNotNull() & F.col("found").isNull()
    joined = children.join(have, "key", "left")
    result = _result(
        check, F.sum(F.when(lost, F.col("n"))), F.coalesce(F.sum("n"), F.lit(0)),
        F.min(F.when(lost, F.col("key").cast("string"))),
    )
    return joined.agg(result.alias("r")).select("r.*")


def gate(results: DataFrame) -> list:
    """Stop a run whose tests failed (DQ-13, DQ-14); returns the result rows."""
    rows = results.collect()
    failed = [r["test_id"] for r in rows if r["status"] == "fail"]
    if failed:
        raise GateError(", ".join(sorted(failed)))
    return rows


# ------------------------------------------------------- tests over whole tables
def metric_drift(
    df: DataFrame,
    day: str,
    metric: Column,
    base_month: dt.date,
    months: int,
    variation: float,
) -> DataFrame:
    """DQ-9: a month's metric against the mean of the ``months`` before it."""
    start = base_month.replace(day=1)
    month = F.trunc(F.col(day), "month")
    first = F.add_months(F.lit(start), -months)
    monthly = (
        df.filter((F.col(day) >= first) & (F.col(day) < F.add_months(F.lit(start), 1)))
        .groupBy(month.alias("month"))
        .agg(metric.cast("double").alias("value"))
    )
    base = F.max(F.when(F.col("month") == F.lit(start), F.col("value")))
    earlier = F.avg(F.when(F.col("month") < F.lit(start), F.col("value")))
    change = F.try_divide(F.col("base_value") - F.col("earlier_mean"), F.col("earlier_mean"))
    return monthly.agg(base.alias("base_value"), earlier.alias("earlier_mean")).select(
        "base_value", "earlier_mean", change.alias("change"),
        F.when(F.abs(change) <= variation, "pass").otherwise("fail").alias("status"),
    )


def compare_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """DQ-10: rows only one version has, each counted as often as it occurs.

    One shuffle for both directions: every distinct row carries the number of
    its copies in either version.
    """
    columns = old.columns
    tagged = old.withColumn("_weight", F.lit(-1)).unionByName(new.withColumn("_weight", F.lit(1)))
    per_row = tagged.groupBy(*columns).agg(F.sum("_weight").alias("surplus"), F.count(F.lit(1)).alias("copies"))
    surplus = F.col("surplus")
    return per_row.agg(
        F.coalesce(F.sum((F.col("copies") - surplus) / 2).cast("bigint"), F.lit(0)).alias("old_rows"),
        F.coalesce(F.sum((F.col("copies") + surplus) / 2).cast("bigint"), F.lit(0)).alias("new_rows"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).cast("bigint").alias("only_in_old"),
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).cast("bigint").alias("only_in_new"),
    )


def consistent_totals(
    left: DataFrame, left_total: Column, right: DataFrame, right_total: Column, tolerance: float
) -> DataFrame:
    """DQ-11: the same figure out of two tables."""
    parts = [
        left.agg(left_total.cast("double").alias("left_total"), F.lit(None).cast("double").alias("right_total")),
        right.agg(F.lit(None).cast("double").alias("left_total"), right_total.cast("double").alias("right_total")),
    ]
    both = reduce(DataFrame.unionByName, parts).agg(
        F.max("left_total").alias("left_total"), F.max("right_total").alias("right_total")
    )
    difference = F.abs(F.col("left_total") - F.col("right_total"))
    return both.select(
        "left_total", "right_total", difference.alias("difference"),
        F.when(difference <= tolerance, "pass").otherwise("fail").alias("status"),
    )
