from __future__ import annotations

from collections import defaultdict

from shoptrail.llm import lines as L
from tests.llm.fixtures import documents, odd_rows, prose, spaced, text

OPTIONS = L.Options(min_docs=4, long_words=20, long_docs=2)


def brute(rows, o=OPTIONS):
    """From the rule: tokens and templates recur by the documents that hold them."""
    def mask(token):
        return "<*>" if any(c.isascii() and c.isdigit() for c in token) else token

    parsed = {i: [(n, tuple(map(mask, spaced(x)))) for n, x in enumerate((t or "").split("\n")) if spaced(x)] for i, t in rows if i is not None}
    leaf = lambda tokens: (len(tokens), tokens[:o.depth])
    least = lambda tokens: min(o.min_docs, o.long_docs) if len(tokens) >= o.long_words else o.min_docs
    reach, holders = defaultdict(set), defaultdict(set)
    every = [(i, t) for i, ls in parsed.items() for _, t in ls]
    for i, t in every:
        reach[leaf(t)].add(i)
        for k, token in enumerate(t):
            holders[leaf(t), k, token].add(i)
    def template(t):
        general = tuple(token if len(holders[leaf(t), k, token]) >= least(t) else None for k, token in enumerate(t))
        return (leaf(t), general) if len(reach[leaf(t)]) >= least(t) and sum(g is not None for g in general) / len(t) >= o.min_fixed else None
    having = defaultdict(set)
    for i, t in every:
        if template(t):
            having[template(t)].add(i)
    out = []
    for i, t in rows:
        lines = parsed.get(i, [])
        size = lambda part: sum(len(ts) for _, ts in part)
        docs = lambda ts: having[template(ts)] if template(ts) else set()
        common = [(n, ts) for n, ts in lines if len(docs(ts)) >= o.min_docs]
        long = [(n, ts) for n, ts in lines if least(ts) <= len(docs(ts)) < o.min_docs and i != min(docs(ts))]
        gone = common + (long if size(long) <= o.long_share * size(lines) else [])
        if size(gone) > o.most_share * size(lines):
            gone = []
        numbers = {n for n, _ in gone}
        out.append((i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in numbers), len(gone), size(gone)))
    return sorted(out, key=str)


def boilerplate(n=8):
    rows = []
    for k in range(n):
        body = text(100 + k, 60).split("\n")
        rows.append((100 + k, "\n".join([f"Posted by user{k} on day {k} of May", *body, "", "All rights are ours", f"See page {k} of our big guide"])))
    rows.append((200, "Posted by hand on some kind of May\n" + text(300, 40)))
    return rows


def test_equals_brute_force(spark):
    rows = odd_rows() + boilerplate()
    docs = documents(spark, rows)
    found = sorted(((r.doc_id, r.text, r.n_dropped, r.n_words_dropped) for r in L.drop_lines(docs, OPTIONS).collect()), key=str)
    assert found == brute(rows)
    assert sum(r[2] for r in found) == 24


def test_variable_words_are_generalised(spark):
    names = ["ann", "bob", "cleo", "dan", "eve", "fay"]
    rows = [(k, f"{text(k, 50)}\nthis page was last changed by {n}") for k, n in enumerate(names)]
    found = L.drop_lines(documents(spark, rows), OPTIONS).collect()
    assert all(r.n_dropped == 1 and "last changed" not in r.text for r in found)


def test_copies_are_left_whole(spark):
    rows = [(k, text(5, 100)) for k in range(9)] + [(50, text(6, 100))]
    assert all(r.n_dropped == 0 and r.text == dict(rows)[r.doc_id] for r in L.drop_lines(documents(spark, rows), OPTIONS).collect())


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(((r.doc_id, r.text, r.n_dropped, r.n_words_dropped) for r in L.drop_lines(docs, OPTIONS).collect()), key=str) == want


def test_lines_of_one_document_do_not_recur(spark):
    """A table of many alike rows stands in one document; the leaf is busy for other reasons."""
    rows = [(k, f"{text(k, 60)}\ntotal price of {' '.join(prose(900 + k, 6))}") for k in range(10)]
    table = "\n".join(f"total price of gift sold to {w} was paid" for w in prose(990, 12))
    rows.append((50, f"{text(51, 60)}\n{table}"))
    found = {r.doc_id: r for r in L.drop_lines(documents(spark, rows)).collect()}
    assert all(r.n_dropped == 0 for r in found.values()) and found[50].text == dict(rows)[50]
    assert brute(rows, L.Options()) == sorted(((r.doc_id, r.text, r.n_dropped, r.n_words_dropped) for r in found.values()), key=str)


def test_a_document_with_several_lines_of_a_template_counts_once(spark):
    """Three documents of four lines each are three documents, not twelve."""
    lines = [[f"see offer number {w} of our great shop today" for w in prose(600 + k, 4)] for k in range(5)]
    rows = [(k, text(k, 80) + "\n" + "\n".join(lines[k])) for k in range(5)]
    for n, want in ((3, 0), (4, 16), (5, 20)):
        found = L.drop_lines(documents(spark, rows[:n]), OPTIONS).collect()
        assert sum(r.n_dropped for r in found) == want
        assert sorted(((r.doc_id, r.text, r.n_dropped, r.n_words_dropped) for r in found), key=str) == brute(rows[:n])


def test_a_long_line_of_few_documents_is_kept_once(spark):
    """A passage of 60 words in three documents of 130 stays in the first; one in half of each text and over may be a copy's."""
    passage = " ".join(prose(700, 60))
    rows = [(k, f"{text(k, 70)}\n{passage}") for k in range(3)] + [(9, text(9, 100))]
    found = {r.doc_id: r for r in L.drop_lines(documents(spark, rows)).collect()}
    assert {k: passage in r.text for k, r in found.items()} == {0: True, 1: False, 2: False, 9: False}
    near = [(k, f"{text(k, 30)}\n{passage}") for k in range(3)]
    assert all(r.n_dropped == 0 for r in L.drop_lines(documents(spark, near)).collect())


def test_boilerplate_of_over_half_a_text_is_dropped(spark):
    """60 recurring words of 100 make no copies: similarity is 0.43."""
    passage = "\n".join(" ".join(prose(800 + k, 12)) for k in range(5))
    rows = [(k, f"{text(k, 40)}\n{passage}") for k in range(12)]
    found = L.drop_lines(documents(spark, rows)).collect()
    assert {r.n_words_dropped for r in found} == {60}


def test_empty_table_and_clashing_columns(spark):
    assert L.drop_lines(documents(spark, [])).collect() == []
    docs = documents(spark, boilerplate()).selectExpr("*", "'x' as of", "1 as n_lines", "array(3) as dropped", "7 as line", "true as common")
    found = L.drop_lines(docs, OPTIONS)
    assert set(found.columns) == set(docs.columns) | {"n_dropped", "n_words_dropped"}
    rows = found.collect()
    assert {r.n_lines for r in rows} == {8, 5}
    assert {(r.of, tuple(r.dropped), r.line, r.common) for r in rows} == {("x", (3,), 7, True)}
    assert sorted(((r.doc_id, r.text, r.n_dropped, r.n_words_dropped) for r in rows), key=str) == brute(boilerplate())
