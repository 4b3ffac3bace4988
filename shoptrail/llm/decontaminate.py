"""Benchmark decontamination with a positional inverted index.

The test items are cut into windows of consecutive words. One pass counts the
items' terms over all training documents; it orders each window's terms from
the rarest. A second pass stores the index: per document, sorted by term, the
postings of all test terms that stand near a window's rarest term. Matching
reads the index alone: it starts from the postings of the rarest term, and
keeps a place while the next term's list holds the place that its offset asks
for. A proximity match asks for all terms within a reach of the rarest one.

The index is sharded by document, so matching moves nothing between tasks. The
items travel with the tasks, in blocks of at most ``block_words`` words.

Defined cases: null or empty texts have no words and never match; an item
without words is no window, one shorter than a window is a window of its own.
Repeated rows are matched alike, each for itself, in any number of blocks.
Empty tables give no matches. Null ids stay null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm import words as W
from shoptrail.llm.tables import importable, settle, text_rows

LENGTH = 10
BLOCK_WORDS = 2_000_000
INDEX = "doc_id long, n_words long, terms array<int>, positions array<int>"
SPANS = "array<struct<item_id:string,start:int,length:int>>"


@dataclass
class Items:
    """The windows of a block of test items."""

    vocabulary: np.ndarray  # sorted term hashes; a term's number is its place
    terms: np.ndarray       # of each window and offset, -1 beyond its length
    lengths: np.ndarray
    item: np.ndarray        # the number of each window's item
    names: list[str]
    order: np.ndarray | None = None    # offsets of each window from the rarest term

    @classmethod
    def of(cls, rows: list[tuple[str, str]], length: int = LENGTH) -> Items:
        names = [r[0] for r in rows]
        w = W.split(pa.array([r[1] for r in rows], pa.string()), W.ALNUM, lower=True)
        vocabulary, ids = np.unique(w.hashes, return_inverse=True)
        found: dict[tuple, None] = {}
        for k, n in enumerate(w.counts):
            own = ids[w.first[k]:w.first[k + 1]]
            size = min(int(n), length)
            if n:
                found.update(((k, *own[s:s + size]), None) for s in range(int(n) - size + 1))
        terms = np.full((len(found), length), -1, np.int64)
        for i, window in enumerate(found):
            terms[i, :len(window) - 1] = window[1:]
        return cls(vocabulary, terms, (terms >= 0).sum(axis=1), np.array([f[0] for f in found], np.int64), names)

    def ranked(self, counts: np.ndarray) -> Items:
        """With each window's offsets ordered from the rarest term of the corpus."""
        rank = np.where(self.terms >= 0, counts[np.maximum(self.terms, 0)] if len(counts) else 0, np.iinfo(np.int64).max)
        self.order = np.argsort(rank, axis=1, kind="stable")
        return self

    @property
    def rarest(self) -> np.ndarray:
        """Each window's rarest term."""
        return self.terms[np.arange(len(self.terms)), self.order[:, 0]]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The term number of each word, or -1."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)


def _cut(length: int, words: int):
    """Long items in pieces that hold ``words`` windows each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            w = W.split(piece["text"], W.ALNUM, hashed=False)
            of, texts = [], []
            for k, n in enumerate(w.counts.tolist()):
                for s in range(0, max(1, n - length + 1), words):
                    last = min(s + words + length - 1, n)
                    of.append(k)
                    texts.append(w.data[w.starts[w.first[k] + s]:w.ends[w.first[k] + last - 1]].tobytes().decode() if n else "")
            yield pa.RecordBatch.from_arrays([piece["item_id"].take(pa.array(of, pa.int64())), pa.array(texts, pa.string())], ["item_id", "text"])

    return run


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, length: int = LENGTH) -> Iterator[list[tuple[str, str]]]:
    """The different test items in blocks that tasks can hold, long ones cut by windows; the size is measured first."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    pieces = importable(items).mapInArrow(_cut(length, max(1, block_words // 16)), "item_id string, text string")
    items = settle(pieces.distinct(), "benchmark-pieces")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word takes two bytes at least, with what parts it from the next one.
    count = 1 + size // (2 * block_words)
    if count == 1:
        yield [tuple(r) for r in items.collect()]
        return
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield [tuple(r) for r in items.filter(number == k).collect()]


def count_terms(docs: DataFrame, items: Items) -> np.ndarray:
    """How often each test term stands in all documents: one row per term and task is summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.vocabulary), np.int64)
        for piece in W.chunks(batches):
            numbers = items.numbers(W.split(piece["text"], W.ALNUM, lower=True).hashes)
            total += np.bincount(numbers[numbers >= 0], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["term", "n"])

    out = np.zeros(len(items.vocabulary), np.int64)
    for term, n in text_rows(docs).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def _postings(piece: pa.RecordBatch, items: Items, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word counts and, in order of document, term and place, the postings near rarest terms."""
    w = W.split(piece["text"], W.ALNUM, lower=True)
    numbers = items.numbers(w.hashes)
    rare = np.zeros(len(items.vocabulary) + 1, bool)
    rare[items.rarest] = True
    of = w.text_of_word()
    at = np.flatnonzero(rare[numbers] & (numbers >= 0))
    low, high = np.maximum(at - reach, w.first[of[at]]), np.minimum(at + reach + 1, w.first[of[at] + 1])
    near = np.flatnonzero(W.covered(len(numbers), low, high - low) & (numbers >= 0))
    near = near[np.lexsort((near, numbers[near], of[near]))]
    return w.counts, of[near], numbers[near], near - w.first[of[near]]


def build_index(docs: DataFrame, items: Items, reach: int = LENGTH - 1) -> DataFrame:
    """The stored index: per document its postings, sorted by term and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            counts, of, terms, places = _postings(piece, items, reach)
            edges = pa.array(np.searchsorted(of, np.arange(piece.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(x, pa.int32())) for x in (terms, places)]
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(counts, pa.int64()), *lists], ["doc_id", "n_words", "terms", "positions"])

    return settle(text_rows(docs).mapInArrow(run, INDEX), "token-index")


def _keys(of: np.ndarray, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (of.astype(np.uint64) << W.U64(52)) | (terms.astype(np.uint64) << W.U64(28)) | places.astype(np.uint64)


def _intersect(of: np.ndarray, terms: np.ndarray, places: np.ndarray, items: Items, slack: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, window, start) of all matches among sorted postings of fewer than 4,096 documents."""
    keys = _keys(of, terms, places)
    by_rarest = np.argsort(items.rarest, kind="stable")
    grouped = items.rarest[by_rarest]
    low, high = np.searchsorted(grouped, terms, "left"), np.searchsorted(grouped, terms, "right")
    many = high - low
    post = np.repeat(np.arange(len(terms)), many)
    window = by_rarest[np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
    doc, anchor = of[post], places[post].astype(np.int64)
    start = anchor - items.order[window, 0]
    for step in range(1, items.order.shape[1]):
        asked = items.lengths[window] > step
        offset = items.order[window, step]
        term = np.where(asked, items.terms[window, offset], 0)
        if slack is None:
            place = start + offset
            key = _keys(doc, term, np.maximum(place, 0))
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            good = (keys[at] == key) & (place >= 0)
        else:
            reach = items.lengths[window] - 1 + slack
            at = np.searchsorted(keys, _keys(doc, term, np.maximum(anchor - reach, 0)))
            good = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] <= _keys(doc, term, anchor + reach))
        good |= ~asked
        doc, window, start, anchor = doc[good], window[good], start[good], anchor[good]
    inside = start >= 0 if slack is None else np.ones(len(start), bool)
    return doc[inside], window[inside], (start if slack is None else anchor)[inside]


_SPANS = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))


def _spans(of: np.ndarray, terms: np.ndarray, places: np.ndarray, rows: int, items: Items, slack: int | None) -> list[list[dict]]:
    """The spans of each of fewer than 4,096 documents."""
    doc, window, start = _intersect(of, terms, places, items, slack)
    spans: list[list[dict]] = [[] for _ in range(rows)]
    for d, w, s in zip(doc.tolist(), window.tolist(), start.tolist(), strict=True):
        spans[d].append({"item_id": items.names[items.item[w]], "start": s, "length": int(items.lengths[w])})
    return spans


def match(index: DataFrame, items: Items, slack: int | None = None) -> DataFrame:
    """doc_id, n_words, spans: exact phrases, or with ``slack`` proximity matches.

    A proximity match's span begins at the rarest term, and all terms of its
    window stand at most (window length - 1 + slack) words from it, in any
    order; the index must have been built with that reach.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4000):
                piece = batch.slice(k, 4000)
                lists = piece["terms"]
                of = np.repeat(np.arange(piece.num_rows), np.diff(lists.offsets.to_numpy()))
                spans = _spans(of, lists.flatten().to_numpy(), piece["positions"].flatten().to_numpy(), piece.num_rows, items, slack)
                yield pa.RecordBatch.from_arrays([piece["doc_id"], piece["n_words"], pa.array(spans, _SPANS)], ["doc_id", "n_words", "spans"])

    return importable(index).mapInArrow(run, f"doc_id long, n_words long, spans {SPANS}")


def _add_spans(rows: DataFrame, items: Items, reach: int, slack: int | None) -> DataFrame:
    """Rows (doc_id, text, spans), with the spans of one more block of items added to each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            for k in range(0, piece.num_rows, 4000):
                part = piece.slice(k, 4000)
                _, of, terms, places = _postings(part, items, reach)
                more = _spans(of, terms, places, part.num_rows, items, slack)
                spans = [old + new for old, new in zip(part["spans"].to_pylist(), more, strict=True)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["text"], pa.array(spans, _SPANS)], ["doc_id", "text", "spans"])

    return importable(rows).mapInArrow(run, f"doc_id long, text string, spans {SPANS}")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in W.chunks(batches):
        counts = W.split(piece["text"], W.ALNUM, lower=True, hashed=False).counts
        yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(counts, pa.int64()), piece["spans"]], ["doc_id", "n_words", "spans"])


def matches(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, slack: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All documents with the spans that match a window of a test item.

    One block of items reads the stored index. Several go over the rows one
    after another and add to their spans, so a row needs no id to stay itself.
    """
    reach = length - 1 + (slack or 0)
    rows, first = text_rows(docs).withColumn("spans", F.array().cast(SPANS)), None
    for k, block in enumerate(blocks(benchmark, block_words, length)):
        items = Items.of(block, length)
        items.ranked(count_terms(docs, items))
        if k:
            rows = _add_spans(rows if first is None else _add_spans(rows, first, reach, slack), items, reach, slack)
            first = None
        else:
            first = items
    if first is not None:
        return match(build_index(docs, first, reach), first, slack)
    return rows.mapInArrow(_counted, f"doc_id long, n_words long, spans {SPANS}")


def summary(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated from matches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, items, marks = [], [], []
            for spans in batch["spans"].to_pylist():
                starts = np.array([s["start"] for s in spans], np.int64)
                lengths = np.array([s["length"] for s in spans], np.int64)
                low = int(starts.min()) if spans else 0
                size = int((starts + lengths).max()) - low if spans else 0
                hits.append(int(W.covered(size, starts - low, lengths).sum()))
                names = sorted({s["item_id"] for s in spans if s["item_id"] is not None})
                items.append(len(names))
                marks.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            columns = [batch["doc_id"], batch["n_words"], pa.array(hits, pa.int64()), pa.array(items, pa.int64()), pa.array(marks, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"])

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string"
    return importable(found).mapInArrow(run, schema).withColumn("contaminated", F.col("n_hit") > 0)


def keep_clean(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents without any exact match, all their columns, in one pass over them for each block of items.

    Each task indexes and matches the rows it holds, so no verdict travels.
    """
    out = docs
    for rows in blocks(benchmark, length=length):
        items = Items.of(rows, length)
        items.ranked(count_terms(docs, items))

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for piece in W.chunks(batches):
                for k in range(0, piece.num_rows, 4000):
                    part = piece.slice(k, 4000)
                    _, of, terms, places = _postings(part, items, length - 1)
                    clean = np.ones(part.num_rows, bool)
                    clean[_intersect(of, terms, places, items, None)[0]] = False
                    yield part.filter(pa.array(clean))

        out = importable(out).mapInArrow(run, docs.schema)
    return out
