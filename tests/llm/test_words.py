from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoptrail.llm import words as W
from tests.llm.fixtures import ALNUM, SPACED, lower

ALPHABET = st.text(alphabet="aB 1\n\t\x0b\x1f-é漢 _", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), ALPHABET), max_size=6))
def test_split_equals_regular_expressions(texts):
    column = pa.array(texts, pa.string())
    for table, low, pattern in ((W.SPACED, False, SPACED), (W.ALNUM, True, ALNUM)):
        w = W.split(column, table, lower=low)
        found = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends, strict=True)]
        want = [pattern.findall(lower(t or "") if low else t or "") for t in texts]
        assert found == [x for t in want for x in t]
        assert w.counts.tolist() == [len(t) for t in want]
        by_word = dict(zip(found, w.hashes.tolist(), strict=True))
        assert [by_word[f] for f in found] == w.hashes.tolist()
        assert len(set(by_word.values())) == len(by_word)


def test_split_reads_slices_and_large_strings():
    column = pa.array(["a b", None, "c", "d e f"], pa.large_string()).slice(1)
    assert W.split(column).counts.tolist() == [0, 1, 3]
    assert W.split(pa.array([], pa.string())).counts.tolist() == []


def test_windows_stay_in_their_text():
    w = W.split(pa.array(["a b c d", "", "a b", "x a b c"]))
    at, keys = W.windows(w.hashes, w.first, 3)
    assert at.tolist() == [0, 1, 6, 7]
    assert keys[0] == keys[3] and len(set(keys.tolist())) == 3


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_chunks_keep_all_rows(limit):
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["aaaa", None, "bbbbbbbbb", "c"]})
    pieces = list(W.chunks(iter([batch]), limit=limit))
    assert [x for p in pieces for x in p["doc_id"].to_pylist()] == [1, 2, 3, 4]
    assert list(W.chunks(iter([batch.slice(0, 0)]))) == []


def test_marks():
    keys = np.array([5, 7, 5, 9, 7], np.uint64)
    assert W.seen_before(keys).tolist() == [False, False, True, False, True]
    assert W.in_several(keys).tolist() == [True, True, True, False, True]
    assert W.covered(6, np.array([1, 2]), 2).tolist() == [False, True, True, True, False, False]
