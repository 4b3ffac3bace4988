"""Line dedup with a log-template tree.

A line's tokens are its words; a token with a digit is a variable field. The
tree has a fixed depth: the token count, then the leading tokens. A leaf that
few documents reach cannot hold a recurring template, so only lines of busy
leaves go on. There a token stays fixed if lines of enough documents have it at
that place; all else is generalised. A template of mostly fixed tokens that
recurs in enough documents is dropped. Documents are counted, never lines: a
table of many rows in one document is one document.

Short lines recur by chance, long ones do not. A template of ``long_words``
tokens recurs from ``long_docs`` documents on; one instance of it is kept, in the
document with the smallest id, unless it recurs in ``min_docs`` documents and so
is boilerplate like any other, which is dropped wherever it stands.

Two kinds of documents share lines because they are copies, and dropping those
would take from document dedup what it compares. A document keeps its long lines
that recur in few documents if they are more than ``long_share`` of its words;
and a document of which more than ``most_share`` would go is left whole. At that
share, 8 of 9 words, two documents with the same lines have a similarity of 0.8.

Defined cases: lines are split at line feeds; lines without a word stay. A
null or empty text has no lines and stays as it is. Rows without id are left
whole. Rows that share an id are one document and must repeat its text. Extra
columns stay, but for those named n_lines, n_dropped and n_words_dropped, which
are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm import words as W
from shoptrail.llm.tables import importable, settle, text_rows, unused

_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_VARIABLE = W.U64(0x5BD1E9955BD1E995)


@dataclass(frozen=True)
class Options:
    """depth: leading tokens in the tree; a template recurs in min_docs documents, or in long_docs from
    long_words tokens on; min_fixed of its tokens are fixed; shares of a document's words, see above."""

    depth: int = 3
    min_docs: int = 10
    long_words: int = 50
    long_docs: int = 3
    min_fixed: float = 0.75
    long_share: float = 0.5
    most_share: float = 8 / 9


@dataclass
class Lines:
    """The lines with words of several texts, and their tokens."""

    words: W.Words
    of: np.ndarray      # the text of each line
    number: np.ndarray  # its number among all lines of the text
    starts: np.ndarray  # bytes
    ends: np.ndarray
    first: np.ndarray   # the number of each line's first token, and the end
    tokens: np.ndarray  # hashes, variable fields alike

    def leaves(self, options: Options) -> np.ndarray:
        """The leaf of each line; its last bit tells whether the line is long."""
        count = np.diff(self.first)
        out = W.mix(count.astype(np.uint64) + W.U64(1))
        for k in range(options.depth):
            there = count > k
            out[there] = W.mix(out[there] * W.U64(31) + self.tokens[self.first[:-1][there] + k])
        return (out & ~W.U64(1)) | (count >= options.long_words).astype(np.uint64)


def lines_of(texts: pa.Array) -> Lines:
    w = W.split(texts)
    n = len(w.first) - 1
    breaks = np.flatnonzero(w.data == 10)
    per_text = w.per_text(w.data == 10) + 1
    starts, ends = np.sort(np.concatenate([w.offsets[:-1], breaks + 1])), np.sort(np.concatenate([breaks, w.offsets[1:]]))
    of = np.repeat(np.arange(n), per_text)
    number = np.arange(len(of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    low, high = np.searchsorted(w.starts, starts), np.searchsorted(w.starts, ends)
    worded = high > low
    digits = np.concatenate([[0], np.cumsum(_DIGIT[w.data], dtype=np.int64)])
    tokens = np.where(digits[w.ends] > digits[w.starts], _VARIABLE, w.hashes)
    # Every word lies in a line with words, so these lines' first tokens tile all words.
    first = np.concatenate([low[worded], [len(w.starts)]])
    return Lines(w, of[worded], number[worded], starts[worded], ends[worded], first, tokens)


def _lists(of: np.ndarray, size: int, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(size + 1)), pa.int32()), pa.array(values, kind))


def _leaf_rows(options: Options):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            found = lines_of(piece["text"])
            columns = [_lists(found.of, piece.num_rows, found.number, pa.int32()), _lists(found.of, piece.num_rows, found.leaves(options).view(np.int64), pa.int64())]
            yield pa.RecordBatch.from_arrays([piece["doc_id"], *columns], ["doc_id", "numbers", "leaves"])

    return run


def _token_rows(options: Options):
    """Of the lines whose numbers are listed: number, leaf, hash of all tokens, tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            found = lines_of(piece["text"])
            asked = piece["numbers"]
            per_row = np.diff(asked.offsets.to_numpy())
            wanted = (np.repeat(np.arange(piece.num_rows), per_row) << 32) | asked.flatten().to_numpy().astype(np.int64)
            chosen = np.flatnonzero(np.isin((found.of << 32) | found.number, wanted))
            leaves = found.leaves(options)[chosen].view(np.int64)
            many = np.diff(found.first)[chosen]
            edges = np.concatenate([[0], np.cumsum(many)])
            at = np.repeat(found.first[:-1][chosen] - edges[:-1], many) + np.arange(edges[-1])
            tokens = found.tokens[at]
            place = (np.arange(edges[-1]) - np.repeat(edges[:-1], many)).astype(np.uint64)
            parts = np.concatenate([[W.U64(0)], np.cumsum(W.mix(tokens + W.mix(place + W.U64(1))), dtype=np.uint64)])
            key = W.mix(parts[edges[1:]] - parts[edges[:-1]] + many.astype(np.uint64)).view(np.int64)
            ids = piece["doc_id"].take(pa.array(found.of[chosen]))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(tokens.view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.number[chosen], pa.int32()), pa.array(leaves, pa.int64()), pa.array(key, pa.int64()), lists], ["doc_id", "number", "leaf", "line", "tokens"])

    return run


def _least(leaf: Column, options: Options) -> Column:
    """In how many documents a template of the leaf recurs at least."""
    return F.when(leaf.bitwiseAND(F.lit(1)) == 1, F.lit(min(options.min_docs, options.long_docs))).otherwise(F.lit(options.min_docs))


def busy_lines(docs: DataFrame, options: Options) -> DataFrame:
    """doc_id, number, leaf, line (its hash) and tokens of all lines in leaves that enough documents reach."""
    rows = text_rows(docs).filter(F.col("doc_id").isNotNull())
    leaves = settle(rows.mapInArrow(_leaf_rows(options), "doc_id long, numbers array<int>, leaves array<long>"), "line-leaves")
    reached = leaves.select(F.explode(F.array_distinct("leaves")).alias("leaf")).groupBy("leaf").agg(F.count("*").alias("docs"))
    busy = settle(reached.filter(F.col("docs") >= _least(F.col("leaf"), options)).select(F.col("leaf").alias("busy")), "line-busy")
    lines = leaves.select("doc_id", F.explode(F.arrays_zip("numbers", "leaves")).alias("line"))
    lines = lines.select("doc_id", F.col("line.numbers").alias("number"), F.col("line.leaves").alias("leaf"))
    kept = lines.join(busy, F.col("leaf") == F.col("busy")).groupBy(F.col("doc_id").alias("of")).agg(F.array_distinct(F.collect_list("number")).alias("numbers"))
    texts = rows.join(settle(kept, "line-asked").hint("shuffle_hash"), F.col("doc_id") == F.col("of")).select("doc_id", "text", "numbers")
    return settle(texts.mapInArrow(_token_rows(options), "doc_id long, number int, leaf long, line long, tokens array<long>"), "line-tokens")


def recurring(busy: DataFrame, options: Options) -> DataFrame:
    """The hashes of lines whose template recurs (line), its tokens with nulls where generalised (template),
    whether it recurs in ``min_docs`` documents (common), and the smallest id of a document that has it (first_doc).

    Equal lines are counted first, so a very common line is one row from there on. Most documents have
    one line of a leaf at most, and such counts of lines are counts of documents; the others' lines are
    told apart by document, so that none counts twice for a token or a template.
    """
    once = settle(busy.groupBy("doc_id", "leaf", "line").agg(F.first("tokens").alias("tokens")), "line-once")
    crowded = once.groupBy("doc_id", "leaf").agg(F.count("*").alias("lines")).filter("lines > 1").select(F.col("doc_id").alias("c_doc"), F.col("leaf").alias("c_leaf"))
    crowded = settle(crowded, "line-crowded")
    same_leaf = (F.col("doc_id") == F.col("c_doc")) & (F.col("leaf") == F.col("c_leaf"))
    flagged = settle(once.join(crowded, same_leaf, "left").select("doc_id", "leaf", "line", "tokens", F.col("c_doc").isNotNull().alias("several")), "line-flagged")
    distinct = flagged.groupBy("line").agg(
        F.first("leaf").alias("leaf"), F.first("tokens").alias("tokens"), F.count_if(~F.col("several")).alias("docs"), F.min("doc_id").alias("first_doc")
    )
    distinct = settle(distinct, "line-distinct")
    fields = distinct.select("line", "leaf", "docs", F.posexplode("tokens").alias("place", "token"))
    several = flagged.filter("several")
    apart = several.select("doc_id", "leaf", F.posexplode("tokens").alias("place", "token")).distinct()
    counted = fields.select("leaf", "place", "token", "docs").unionByName(apart.select("leaf", "place", "token", F.lit(1).cast("long").alias("docs")))
    fixed = counted.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("n")).filter(F.col("n") >= _least(F.col("leaf"), options))
    fixed = settle(fixed.select(F.col("leaf").alias("f_leaf"), F.col("place").alias("f_place"), F.col("token").alias("f_token")), "line-fields")
    on = (F.col("leaf") == F.col("f_leaf")) & (F.col("place") == F.col("f_place")) & (F.col("token") == F.col("f_token"))
    general = fields.join(fixed, on, "left").groupBy("line", "leaf", "docs").agg(
        F.sort_array(F.collect_list(F.struct("place", F.col("f_token").alias("token")))).alias("fields")
    )
    general = general.withColumn("template", F.transform("fields", lambda f: f["token"])).drop("fields")
    held = F.size(F.filter("template", lambda t: t.isNotNull())) / F.size("template")
    general = general.filter(held >= options.min_fixed).withColumn("name", F.xxhash64("leaf", "template"))
    general = settle(general.join(distinct.select(F.col("line").alias("d_line"), "first_doc"), F.col("line") == F.col("d_line")).drop("d_line"), "line-general")
    named = several.select("doc_id", "line").join(general.select(F.col("line").alias("g_line"), "name", "leaf", "first_doc"), F.col("line") == F.col("g_line"))
    apart = named.groupBy("doc_id", "name").agg(F.first("leaf").alias("leaf")).select("name", "leaf", F.lit(1).cast("long").alias("docs"), F.col("doc_id").alias("first_doc"))
    known = general.select("name", "leaf", "docs", "first_doc").unionByName(apart).groupBy("name").agg(F.first("leaf").alias("leaf"), F.sum("docs").alias("docs"), F.min("first_doc").alias("first_doc"))
    known = known.filter(F.col("docs") >= _least(F.col("leaf"), options)).select(F.col("name").alias("k_name"), (F.col("docs") >= options.min_docs).alias("common"), F.col("first_doc").alias("k_first"))
    known = settle(known, "line-templates")
    return settle(general.join(known, F.col("name") == F.col("k_name")).select("line", "template", "common", F.col("k_first").alias("first_doc")), "line-recurring")


def _apply(options: Options, taken: str, decided: str, out_names: list[str]):
    """Cut the listed lines: those of common templates, then those of long ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches, taken):
            texts = piece[taken]
            found = lines_of(texts)
            n = piece.num_rows
            many = np.diff(found.first)
            total = found.words.counts
            here = (found.of << 32) | found.number

            def asked(kind: str) -> tuple[np.ndarray, np.ndarray]:
                lists = pc.struct_field(piece[decided], kind)
                lists = pc.if_else(pc.is_null(lists), pa.scalar([], lists.type), lists)
                of = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                hit = np.isin(here, (of << 32) | lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
                return hit, np.bincount(found.of[hit], weights=many[hit], minlength=n).astype(np.int64)

            hit, lost = asked("common")
            long, lost_long = asked("long")
            copies = lost_long > options.long_share * total
            hit |= long & ~copies[found.of]
            lost += np.where(copies, 0, lost_long)
            whole = lost > options.most_share * total
            hit &= ~whole[found.of]
            lost[whole] = 0
            cut = texts.to_pylist()
            for k in np.unique(found.of[hit]).tolist():
                gone = set(found.number[hit & (found.of == k)].tolist())
                cut[k] = "\n".join(line for i, line in enumerate(cut[k].split("\n")) if i not in gone)
            arrays = {
                taken: pa.array(cut, pa.string()),
                "n_lines": pa.array(np.bincount(found.of, minlength=n), pa.int64()),
                "n_dropped": pa.array(np.bincount(found.of[hit], minlength=n), pa.int64()),
                "n_words_dropped": pa.array(lost, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([arrays[c] if c in arrays else piece[c] for c in out_names], out_names)

    return run


def drop_lines(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """All documents, their text without the dropped lines, with n_lines (those with words), n_dropped and n_words_dropped."""
    extra = ("n_lines", "n_dropped", "n_words_dropped")
    base = docs.drop(*extra)
    busy = busy_lines(base, options)
    known = recurring(busy, options).select(F.col("line").alias("known"), "common", "first_doc")
    hits = busy.select("doc_id", "number", "line").join(known, F.col("line") == F.col("known")).filter(F.col("common") | (F.col("doc_id") != F.col("first_doc")))
    listed = lambda c: F.array_distinct(F.collect_list(F.when(c, F.col("number"))))
    # Names that no column of the documents has.
    of, decided = (unused(base, name) for name in ("of", "dropped"))
    lists = F.struct(listed(F.col("common")).alias("common"), listed(~F.col("common")).alias("long"))
    decisions = settle(hits.groupBy(F.col("doc_id").alias(of)).agg(lists.alias(decided)), "line-decisions")
    rows = base.join(decisions.hint("shuffle_hash"), base["doc_id"].cast("long") == decisions[of], "left").drop(of)
    names = [c for c in base.columns if c != "text"]
    schema = base.select(*[F.col(f"`{c}`") for c in names], F.col("text").cast("string").alias("text"), *[F.lit(0).cast("long").alias(c) for c in extra]).schema
    ready = importable(rows).withColumn("text", F.col("text").cast("string"))
    return ready.mapInArrow(_apply(options, "text", decided, schema.names), schema)
