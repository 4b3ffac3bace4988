from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptrail.llm import negatives as N

SCHEMA = "vec_id long, label int, embedding array<double>, rank int, block string, at int, score long, found int"


def table(spark, rows):
    """With extra columns that clash with those the operator adds."""
    return spark.createDataFrame([(*r, 1, "b", 2, 3, 4) for r in rows], SCHEMA)


def brute(rows, options=N.Options(), every=100):
    held = [(i, c, [math.floor(options.scale * x) for x in v]) for i, c, v in rows if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, c, v) in enumerate(held):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j, d, b) for b, (j, d, w) in enumerate(held))
        positives = [(s, j) for s, j, d, b in scored if d == c and b != a][:options.positives]
        for s, j in positives:
            near = [(t, k) for t, k, d, _ in scored if d != c and options.low * -s <= 100 * -t <= options.high * -s][:options.negatives]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(near)]
    return sorted(out)


def found(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def cases(n=900, dims=20, seed=3):
    """Random rows, some equal to each other, odd ones, and repeated ids."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, dims))
    rows = [(i, int(rng.integers(4)), (centre[rng.integers(4)] + 0.4 * rng.normal(size=dims)).tolist()) for i in range(n)]
    for i in range(100, 400, 3):
        rows[i] = (i, rows[i][1], rows[100][2])  # a vector in many rows: ties
    rows += [(1000, None, rows[0][2]), (1001, 1, None), (1002, 1, [None] * dims), (1003, 2, [float("nan")] * dims), (1004, 2, [float("inf")] + [0.0] * (dims - 1)),
             (None, 1, rows[0][2]), (1100, 1, []), (1200, 1, [1.0, 2.0]), (1201, 2, [1.0] * (dims + 9)), (200, 1, rows[5][2]), (200, 3, rows[6][2]), (7, 2, rows[7][2]), (7, 2, rows[7][2])]
    return rows


@pytest.mark.parametrize("options", [N.Options(), N.Options(rows=50, anchors=2, blocks=3, spread=1), N.Options(positives=1, negatives=3, low=0, high=100, scale=7)])
def test_equals_brute_force(spark, options):
    rows = cases()
    assert found(N.mine(table(spark, rows), F.col("vec_id") % 100 == 0, options)) == brute(rows, options)


def test_scores_are_exact_products():
    rng = np.random.default_rng(1)
    for low, high, kind in ((-3, 3, np.int32), (-300, 300, np.int32), (-1, 0, np.int32), (-(10**6), 10**6, np.int64), (-(2**62), 2**62, np.int64)):
        a, b = rng.integers(low, high, (5, 24), dtype=np.int64), rng.integers(low, high, (1100, 24), dtype=np.int64)
        bits = N.pack(b)
        with np.errstate(over="ignore"):
            assert (N.scores(N.subset_sums(a.astype(kind)), bits).astype(np.int64) == a @ b.T).all()
        assert (N.unpack(bits, np.arange(1100)) == b).all()


def test_subset_sums_name_every_byte():
    a = np.arange(16).reshape(1, 16)
    tables = N.subset_sums(a)
    assert all(tables[g, byte, 0] == sum(a[0, 8 * g + k] for k in range(8) if byte >> k & 1) for g in range(2) for byte in range(256))


def test_large_numbers(spark):
    """Components of any finite size have a defined integer."""
    rows = [(0, 1, [1e300, -1e300]), (1, 1, [3e7, 2.0]), (2, 2, [1e7, 1.0]), (100, 1, [2e3, 0.0]), (3, 2, [1.4e7, 0.0])]
    got = found(N.mine(table(spark, rows), F.col("vec_id") == 100))
    assert [r[:4] for r in got if r[1] == 1] == [(100, 1, 1, 3), (100, 1, 2, 2)]
    assert N._integers(np.array([1e308, -1e308, 0.5, -0.001]), 256).tolist() == [1 << 62, -(1 << 62), 128, -1]


def test_float_vectors_and_no_anchor(spark):
    rows = table(spark, cases(420)).withColumn("embedding", F.col("embedding").cast("array<float>"))
    plain = [(r.vec_id, r.label, r.embedding) for r in rows.collect()]
    assert found(N.mine(rows, F.col("vec_id") % 10 == 0)) == brute(plain, every=10)
    assert found(N.mine(rows, F.col("vec_id") == -5)) == []
    assert found(N.mine(rows.limit(0), F.col("vec_id") % 10 == 0)) == []


def test_work_of_a_meeting_does_not_follow_the_data(spark):
    """A third of all rows in one vector and label: blocks and groups stay bounded."""
    docs = spark.range(6000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).alias("label"), F.array([F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") % k / k) for k in range(7, 15)]).alias("embedding"))
    blocks = N.packed(docs, F.col("vec_id") % 100 == 0, N.Options(rows=256))
    assert blocks.selectExpr("max(length(ids))").first()[0] <= 256 * 8
    assert blocks.selectExpr("sum(length(ids) div 8)").first()[0] == 6000
