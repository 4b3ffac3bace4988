from __future__ import annotations

import random
from itertools import combinations

import pytest

from shoptrail.llm import neardup as N
from tests.llm.fixtures import documents, lower, odd_rows, prose, spaced


def shingles(t, size):
    ws = spaced(lower(t or ""))
    return {tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def brute(rows, size):
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted(((i, len(shingles(t, size)), None if i is None else find(i), i is None or find(i) == i) for i, t in rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(n, of=300, step=37):
    """A chain: each text differs from the one before by a word."""
    words, rows = prose(9, of), []
    for k in range(n):
        words = list(words)
        words[(k * step) % of] = f"new{k}"
        rows.append((1000 + k, " ".join(words)))
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_equals_brute_force(spark, size):
    rows = odd_rows() + near_copies(40) + [odd_rows()[3]]
    assert found(N.group(documents(spark, rows), N.Options(shingle=size))) == brute(rows, size)


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 4)
    assert found(N.group(docs, N.Options(shingle=4))) == want


def test_large_group_over_many_tasks(spark):
    """A group of which every region is large, cut at many places, is one component."""
    rows = near_copies(150, of=2000, step=7) + [(k, "same old text with some words") for k in range(200)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = found(N.group(documents(spark, rows), N.Options(shingle=4)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r[2] for r in got} == {0, 1000} and sum(r[3] for r in got) == 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 90), (90, 70), (70, 50), (100, 101)] + [(200, k) for k in range(201, 240)]
    links = spark.createDataFrame(edges, "a long, b long")
    got = dict(N.components(links).collect())
    assert got == {**{k: 1 for k in range(2, 41)}, 90: 50, 70: 50, 101: 100, **{k: 200 for k in range(201, 240)}}


def test_keeps_one_of_each_group(spark):
    rows = odd_rows() + near_copies(5)
    docs = documents(spark, rows)
    kept = N.keep_one(docs, N.Options(shingle=4))
    assert kept.schema.names == docs.schema.names
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in brute(rows, 4) if r[3]), key=str)


def test_empty_table(spark):
    assert N.group(documents(spark, [])).collect() == []
    assert N.group(documents(spark, [(1, None), (None, None), (2, " ")])).count() == 3


def test_rows_at_the_rim_of_a_large_group(spark):
    """Most texts of a group are linked by way of others; those with few links must not be lost."""
    rng, base, rows = random.Random(3), prose(4, 150), []
    for k in range(500):
        words = list(base)
        for at in rng.sample(range(150), rng.choice([2, 3, 3, 4, 5])):
            words[at] = f"w{rng.randrange(10**9)}"
        rows.append((k * 3 + 1, " ".join(words)))
    want = brute(rows, 4)
    assert 1 < len({r[2] for r in want}) < 500
    assert found(N.group(documents(spark, rows), N.Options(shingle=4))) == want
    small = N.Options(shingle=4, block=2_000, largest=2)
    assert found(N.group(documents(spark, rows), small)) == want


def test_pairs_of_one_template_in_wide_regions(spark):
    """Many documents share a template (0.74 alike); each has one near copy, which no rank may hide."""
    rng, base, rows, size = random.Random(8), prose(4, 400), [], 4
    for k in range(250):
        words = list(base)
        for at in rng.sample(range(0, 400, 4), 8):
            words[at] = f"w{rng.randrange(10**9)}"
        copy = list(words)
        for at in rng.sample(range(2, 398, 4), 10):
            copy[at] = f"w{rng.randrange(10**9)}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    want = brute(rows, size)
    assert 200 < len({r[2] for r in want}) <= 250
    assert found(N.group(documents(spark, rows), N.Options(shingle=size))) == want
    assert found(N.group(documents(spark, rows), N.Options(shingle=size, block=20_000, rows=50))) == want
