"""Exact money, free-form properties, and text feeds in which no line is lost."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from shoptrail.functions.money import money, money_sum
from shoptrail.functions.variants import broken, parsed, typed, typed_paths
from shoptrail.session import work_path
from shoptrail.sources import text_feeds as T


# ---------------------------------------------------------------------- money
def test_money_takes_the_digits_a_number_is_written_with(spark):
    values = [0.1, 1e-9, 5e-10, -5e-10, 4e-10, 1e15, 123456.789, 2.675, None, float("nan"), float("inf"), 1e300]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(money("v")).collect()]
    exact = lambda v: Decimal(repr(v)).quantize(Decimal("1e-9"), ROUND_HALF_UP)
    assert got[:8] == [exact(v) for v in values[:8]] and got[8:] == [None] * 4


def test_sums_do_not_depend_on_order(spark):
    rng = random.Random(2)
    values = [rng.choice([0.1, 0.2, 1e12 + 0.1, -1e12, 3.33]) for _ in range(2_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = sum(Decimal(repr(v)) for v in values)
    for parts in (1, 7):
        assert df.repartition(parts).agg(money_sum(money("v"))).first()[0] == want
    big = spark.createDataFrame([(Decimal("9" * 29),)] * 2, "v decimal(38,9)")
    assert big.agg(money_sum("v")).first()[0] is None  # too large: no wrong digits, no error
    assert df.limit(0).agg(money_sum(money("v"))).first()[0] is None


# ------------------------------------------------------------------- variants
def test_types_are_found_over_all_rows(spark):
    texts = ['{"a": 1, "b": 1.5, "c": true, "d": "x", "e": {"f": [1, {"g, h": 2}]}, "odd name: <x>": 4}', '{"a": 2.5, "b": 7, "c": null}', '{"d": 5}', "[1, 2]", "7", "{broken", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("v", parsed("t"))
    types = typed_paths(df, "v")
    assert {k: types[k] for k in "abcde"} == {"a": "double", "b": "double", "c": "boolean", "d": "string", "e": "string"}
    rows = df.orderBy("i").select(broken("t", "v").alias("broken"), *typed("v", {k: types[k] for k in "abcde"})).collect()
    assert [r.broken for r in rows] == [False] * 5 + [True, False, True]
    assert [r.a for r in rows[:3]] == [1.0, 2.5, None] and [r.d for r in rows[:3]] == ["x", None, "5"]
    assert rows[0].e == '{"f":[1,{"g, h":2}]}' and all(r[1:] == (None,) * 5 for r in rows[3:])
    assert typed_paths(df.limit(0), "v") == {}


# ----------------------------------------------------------------- text feeds
FIELDS = {"id": "string", "at": "timestamp", "n": "bigint"}


def written(spark, lines):
    path = work_path(spark, "text")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return T.read_lines(spark, path)


def test_separated_lines_are_rows_or_rejected(spark):
    lines = ["a\t2024-01-01 00:00:00\t1", 'b "x"\t2024-01-01 00:00:00\t', "c\tnever\t1", "d\t2024-01-01 00:00:00", "e\t2024-01-01 00:00:00\t1\t2", "\t2024-01-01 00:00:00\t1", "f\t\t3", "g\t2024-01-01 00:00:00\tmany", "  ", ""]
    done = T.parse_separated(written(spark, lines), FIELDS, ["id", "at"])
    assert sorted((r.id, r.n) for r in done.rows.collect()) == [("a", 1), ('b "x"', None)]
    rejected = {r.line: r.reason for r in done.rejected.collect()}
    assert rejected == {lines[2]: T.UNTYPED, lines[3]: T.MALFORMED, lines[4]: T.MALFORMED, lines[5]: T.MISSING, lines[6]: T.MISSING, lines[7]: T.UNTYPED}
    assert done.rejected.filter("file like '%text%'").count() == 6
    assert done.rows.columns == list(FIELDS)


def test_json_lines_bring_new_columns(spark):
    lines = ['{"id": "a", "at": "2024-01-01T00:00:00", "n": 1, "new": 5}', '{"id": "b", "at": "2024-01-01T00:00:00", "new": 2.5, "deep": {"x": 1}}', '{"id": "c", "at": 1, "n": "many"}', '{"n": 3}', "[1]", '"text"', "{", '{"id": "d", "at": "2024-01-01T00:00:00"}']
    done = T.parse_json(written(spark, lines), FIELDS, ["id", "at"])
    assert done.rows.columns == [*FIELDS, "deep", "new"]
    assert sorted((r.id, r.n, r.new, r.deep) for r in done.rows.collect()) == [("a", 1, 5.0, None), ("b", None, 2.5, '{"x":1}'), ("d", None, None, None)]
    reasons = {r.line: r.reason for r in done.rejected.collect()}
    assert reasons == {lines[2]: T.UNTYPED, lines[3]: T.MISSING, lines[4]: T.MALFORMED, lines[5]: T.MALFORMED, lines[6]: T.MALFORMED}
    assert T.parse_json(written(spark, lines), FIELDS, ["id"], new_columns=False).rows.columns == list(FIELDS)


def test_rows_in_are_rows_good_and_rejected(spark):
    rng = random.Random(5)
    lines = ["\t".join(rng.choice(["", "x", "2024-02-02 01:01:01", "3", '"', "\\", "é"]) for _ in range(rng.choice([2, 3, 3, 3, 4]))) + "." for _ in range(500)]
    for parse in (T.parse_separated, T.parse_json):
        done = parse(written(spark, lines), FIELDS, ["id"])
        assert done.rows.count() + done.rejected.count() == 500
        assert done.rejected.filter(F.col("reason").isNull()).count() == 0
