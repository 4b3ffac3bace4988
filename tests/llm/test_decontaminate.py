from __future__ import annotations

import pytest

from shoptrail.llm import decontaminate as D
from tests.llm.fixtures import alnum, documents, odd_rows, prose, sha


def brute(docs, items, length=10):
    windows = [(str(i), ws[s:s + min(length, len(ws))]) for i, t in items if (ws := alnum(t)) for s in range(len(ws) - min(length, len(ws)) + 1)]
    by_first = {}
    for name, w in windows:
        by_first.setdefault(w[0], []).append((name, w))
    out = []
    for i, t in docs:
        ws, hit, names = alnum(t), set(), set()
        for s, word in enumerate(ws):
            for name, w in by_first.get(word, ()):
                if ws[s:s + len(w)] == w:
                    hit |= set(range(s, s + len(w)))
                    names.add(name)
        out.append((i, len(ws), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return sorted(out, key=str)


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def cases():
    words = prose(77, 60)
    items = [(1, " ".join(words[5:30])), (2, " ".join(w.upper() + "!" for w in words[40:52])), (12, "one"), (3, None), (4, "?!"),
             (5, "a a a"), (10, "Two, three"), (6, " ".join(prose(900, 20))), (1, " ".join(words[5:30]))]
    return odd_rows() + odd_rows()[7:9], items


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 150])
def test_equals_brute_force(spark, block_words):
    rows, items = cases()
    found = D.summary(D.matches(documents(spark, rows), items_table(spark, items), block_words=block_words)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, items)


def test_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert sorted((tuple(r) for r in D.summary(D.matches(docs, bench)).collect()), key=str) == want
    assert sorted(r.doc_id for r in D.keep_clean(docs, bench).collect()) == [w[0] for w in sorted(want) if not w[5]]


def test_proximity(spark):
    docs = documents(spark, [(1, "red one blue two green"), (2, "green blue red"), (3, "red " + "x " * 9 + "green blue"), (4, "red blue")])
    items = items_table(spark, [(7, "red blue green")])
    near = {r.doc_id: len(r.spans) for r in D.matches(docs, items, length=3, slack=2).collect()}
    assert {k for k, n in near.items() if n} == {1, 2}


def test_empty_tables(spark):
    rows, items = cases()
    assert D.summary(D.matches(documents(spark, []), items_table(spark, items))).collect() == []
    none = D.summary(D.matches(documents(spark, rows), items_table(spark, []))).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)
    assert D.keep_clean(documents(spark, rows), items_table(spark, [])).count() == len(rows)


def test_clean_documents_keep_their_columns(spark):
    rows, items = cases()
    docs = documents(spark, rows)
    kept = D.keep_clean(docs, items_table(spark, items))
    assert kept.schema.names == docs.schema.names
    want = {r[0] for r in brute(rows, items) if not r[5]}
    assert {r.doc_id for r in kept.collect()} == want


def test_repeated_and_null_ids_in_several_blocks(spark):
    """Every row stays itself, whatever the number of blocks."""
    rows, items = cases()
    hit = rows[7][1]
    rows += [(None, hit), (None, "no words of a test"), (7, "other text under a used id")]
    found = D.summary(D.matches(documents(spark, rows), items_table(spark, items), block_words=150)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, items)


def test_blocks_are_bounded(spark):
    """One long item is cut by windows, and one in many rows is taken once."""
    long = " ".join(prose(901, 1000))
    blocks = list(D.blocks(items_table(spark, [(1, long)] + [(2, "the same words " * 20)] * 50), 200))
    assert max(sum(len(alnum(t)) for _, t in b) for b in blocks) < 1000
    assert sum(t.startswith("the same") for b in blocks for _, t in b) < 50
    rows = [(1, " ".join(prose(901, 1000)[k:k + 10])) for k in range(0, 990, 33)] + [(2, long)]
    found = D.summary(D.matches(documents(spark, rows), items_table(spark, [(1, long)]), block_words=200)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, [(1, long)])
