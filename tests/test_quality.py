from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoptrail.operators import quality as q
from shoptrail.plans import checks


def results(df):
    return {r["test_id"]: r for r in df.collect()}


def test_all_declared_tests_are_there(spark):
    def count(models):
        return sum(len(d.checks()) for d in models.values())

    assert (count(checks.STAGING), count(checks.INTEGRATION), count(checks.WAREHOUSE)) == (53, 34, 55)
    assert count(checks.DECLARED) == 142


def test_each_kind_of_test(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "z"), (None, 3, "x")], "k string, n int, v string")
    parent = spark.createDataFrame([("x",), ("x",), (None,)], "v string")
    got = results(q.run_checks("t", df, [
        q.unique("k"), q.unique("n"), q.unique_combination(["k", "n"]), q.not_null("v"), q.not_null_where("v", F.col("n") == 2),
        q.accepted_values("v", ["x"]), q.not_constant("n"), q.expression_is_true("n < 3", F.col("n") < 3),
        q.relationships("v", parent, "v"),
    ]))
    failures = {k: (r["failures"], r["total"], r["sample"]) for k, r in got.items()}
    assert failures == {
        "t.k.unique": (1, 4, "a"),
        "t.n.unique": (1, 4, "3"),
        "t.k-n.unique_combination_of_columns": (0, 4, None),
        "t.v.not_null": (1, 4, None),
        "t.v.not_null_where": (1, 4, None),
        "t.v.accepted_values": (1, 4, "z"),
        "t.n.not_constant": (0, 4, None),
        "t.n < 3.expression_is_true": (2, 4, None),
        "t.v.relationships": (1, 4, "z"),
    }


def test_constant_column_and_empty_table(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    assert results(q.run_checks("t", df, [q.not_constant("k")]))["t.k.not_constant"]["failures"] == 1
    none = results(q.run_checks("t", df.limit(0), [q.not_constant("k"), q.unique("k"), q.not_null("k"), q.relationships("k", df, "k")]))
    assert {r["status"] for r in none.values()} == {"pass"}
    assert {r["total"] for r in none.values()} == {0}


def test_warnings_pass_the_gate_and_errors_do_not(spark):
    df = spark.createDataFrame([(None,)], "k string")
    rows = q.gate(q.run_checks("t", df, [q.not_null("k", severity=q.WARN)]))
    assert [r["status"] for r in rows] == ["warn"]
    with pytest.raises(q.GateError, match="t.k.not_null"):
        q.gate(q.run_checks("t", df, [q.not_null("k")]))


def test_row_tests_of_a_table_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id as a", "id as b").write.parquet(path)
    df = q.run_checks("t", spark.read.parquet(path), [q.not_null("id"), q.not_null("a"), q.accepted_values("b", [1, 2])])
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_logical_checks(spark):
    funnel = spark.createDataFrame([(5, 4, 3, 2, 1), (1, 2, 0, 0, 0)], ", ".join(
        f"sessions_with_{s} long" for s in ("pageview", "product_view", "add_to_cart", "begin_checkout", "purchase")))
    got = results(q.run_checks("conversion_funnel_fct", funnel, checks.logical_checks("conversion_funnel_fct")))
    assert [(r["failures"], r["status"]) for r in got.values()] == [(1, "warn")]


def test_metric_drift(spark):
    rows = [(dt.date(2024, 1, 5), 10.0), (dt.date(2024, 2, 5), 20.0), (dt.date(2024, 3, 5), 30.0), (dt.date(2023, 12, 5), 999.0)]
    df = spark.createDataFrame(rows, "day date, value double")
    row = q.metric_drift(df, "day", F.sum("value"), dt.date(2024, 3, 31), 2, 0.5).first()
    assert (row.base_value, row.earlier_mean, row.change, row.status) == (30.0, 15.0, 1.0, "fail")
    assert q.metric_drift(df, "day", F.sum("value"), dt.date(2024, 3, 31), 2, 1.0).first().status == "pass"


def test_compare_versions_counts_copies(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", None), ("b", None), ("d", 4)], "k string, v int")
    assert tuple(q.compare_versions(old, new).first()) == (4, 4, 2, 2)
    assert tuple(q.compare_versions(old, old).first()) == (4, 4, 0, 0)


def test_consistent_totals(spark):
    left = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    right = spark.createDataFrame([(2.5,)], "y double")
    row = q.consistent_totals(left, F.sum("x"), right, F.sum("y"), 1.0).first()
    assert (row.difference, row.status) == (0.5, "pass")
    assert q.consistent_totals(left, F.sum("x"), right, F.sum("y"), 0.1).first().status == "fail"
