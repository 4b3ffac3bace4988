from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoptrail.llm import exact as X
from tests.llm.fixtures import documents, lower, odd_rows, sha

SMALL = X.Options(slice_bits=X.BLOCK)


def brute(rows):
    """doc_id, keep_id, group_size, text_sha256 of each row; and of each group one row kept."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t or "")].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), sha(t)) for i in ids]
    return sorted(out, key=str), sorted((sha(t), max((i for i in ids if i is not None), default=None)) for t, ids in groups.items())


def found(df):
    rows = df.collect()
    every = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)
    return every, sorted((r.text_sha256, r.doc_id) for r in rows if r.kept)


def cases():
    """Odd rows, with upper and lower case, other letters' case, repeated rows, ids and texts."""
    more = [(30, "Same Text"), (31, "sAME tEXT"), (32, "ÉCOLE"), (33, "école"), (34, "İx"), (35, "Same Text"), (35, "Same Text"), (36, None), (36, ""), (None, "Same text"), (None, "ONLY null"), (None, "only NULL")]
    return odd_rows() + more


@pytest.mark.parametrize("options", [X.Options(), SMALL, X.Options(bits=1, places=1)])
def test_equals_brute_force(spark, options):
    rows = cases()
    assert found(X.groups(documents(spark, rows), options)) == brute(rows)


@pytest.mark.parametrize("options", [X.Options(), X.Options(bits=1, places=1)])
def test_keep_one_keeps_columns_and_one_row_of_each_text(spark, options):
    rows = cases()
    docs = documents(spark, rows).withColumns({"digest": F.lit("mine"), "maybe": F.lit(3), "n": F.lit("n"), "doc": F.lit(1), "keep": F.lit(2), "row": F.lit(5)})
    kept = X.keep_one(docs, options)
    assert kept.schema == docs.schema
    out = kept.collect()
    assert sorted((sha(lower(r.text or "")), r.doc_id) for r in out) == brute(rows)[1]
    assert {(r.digest, r.maybe, r.n, r.doc, r.keep, r.row) for r in out} == {("mine", 3, "n", 1, 2, 5)}


def test_slices_cover_all_digests(spark):
    """A filter in many slices finds what one finds."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 39_000).cast("string")).alias("text"))
    layout = X.Layout.of(40_000, SMALL)
    assert len(layout.slices()) == 10
    for options in (SMALL, X.Options()):
        done = X.groups(docs, options).agg(F.count("*"), F.sum("group_size"), F.sum(F.col("kept").cast("int")), F.sum("keep_id")).first()
        assert tuple(done) == (40_000, 38_000 + 4 * 1000, 39_000, sum(range(40_000)) + 39_000 * 1000)


def test_few_single_rows_are_shuffled(spark):
    """Rows that repeat nothing pass the filter by, but for a small share."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.greatest("id", F.lit(10_000)).cast("string")).alias("text"))
    marked = X.possibly_repeated(X._digests(docs))
    maybe = marked.filter("maybe").count()
    assert 10_001 <= maybe < 10_001 + 0.01 * 30_000


def test_a_text_in_a_third_of_all_rows_comes_to_its_block_once_per_task():
    digests = np.repeat(np.frombuffer(bytes.fromhex(sha("hot")), np.uint8)[None], 50_000, axis=0)
    part = X._set_places(X.Layout.of(150_000, X.Options()))
    batch = pa.RecordBatch.from_arrays([pa.array([d.tobytes() for d in digests], pa.binary())], ["digest"])
    out = list(part(iter([batch])))
    assert [b.num_rows for b in out] == [1]
    assert len(out[0]["once"][0].as_py()) == 0 and len(out[0]["twice"][0].as_py()) == 8


def test_empty_table(spark):
    assert X.groups(documents(spark, [])).collect() == []
    assert X.keep_one(documents(spark, [])).collect() == []
    assert X.groups(documents(spark, [])).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]

