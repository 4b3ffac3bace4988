"""Near-duplicate documents with an LSH forest.

Each document's set holds its distinct word shingles, lower-cased (A-Z). Equal
sets are one class with the smallest id for representative, so exact copies
cost one row from there on. A representative has one minimum per hash function.
The forest has several trees; a tree's order is the lexicographic order of
these minima, begun at the tree's own functions. Neighbours with a long common
prefix are candidates: a region starts with all rows that share a tree's least
depth and is cut at greater depth until it is small; a region that stays large
at full depth is chained to its next neighbours. Sorting is by range with the id
as last key, so a group of any size is spread over tasks; what lies at a cut is
compared once more, together.

Candidates whose sizes allow the similarity are confirmed on full sets, and
links are closed to components by alternating star contractions. A region that
was too large at the least depth may hide links between rows that stayed in
different components: all its rows are then compared on full sets, in blocks,
save those of one component.

Defined cases: a text of fewer words than a shingle has its whole sequence as
one shingle; a null text or one without words has an empty set and is linked
with nothing. Ties go to the smallest id. Rows that share an id are one
document and must repeat its text; each gives a row. Rows without id are kept
and linked with nothing. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm import words as W
from shoptrail.llm.tables import importable, settle, tasks, text_rows


@dataclass(frozen=True)
class Options:
    """words in a shingle, similarity in percent; trees, least and full depth, rows of a small region,
    neighbours in a chain; components of a large region that have blocks of their own, and shingles and rows in a block."""

    shingle: int = 5
    percent: int = 80
    trees: int = 24
    least: int = 4
    full: int = 16
    region: int = 8
    chain: int = 2
    largest: int = 8
    block: int = 200_000
    rows: int = 2_000

    @property
    def functions(self) -> int:
        return self.trees * self.least


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts, one after another, and where each text's begin."""
    w = W.split(texts, W.SPACED, lower=True)
    at, keys = W.windows(w.hashes, w.first, size)
    of = w.text_of_word()[at]
    for n in range(1, size):  # the few texts that are shorter than a shingle
        short = w.counts == n
        if short.any():
            first = w.first[:-1][short]
            joined = np.zeros(len(first), np.uint64)
            for k in range(n):
                joined = W.mix(joined * W.U64(31) + w.hashes[first + k] + W.U64(n))
            keys, of = np.concatenate([keys, joined]), np.concatenate([of, np.flatnonzero(short)])
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    if len(keys):
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
        keys, of = keys[new], of[new]
    return keys, np.searchsorted(of, np.arange(len(w.first)))


def _sums(keys: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[W.U64(0)], np.cumsum(keys, dtype=np.uint64)])
    return (total[edges[1:]] - total[edges[:-1]]).view(np.int64)


def _sketch(options: Options):
    rng = np.random.default_rng(715)
    factor = rng.integers(1, 1 << 63, options.functions, dtype=np.uint64) | W.U64(1)
    salt = rng.integers(0, 1 << 63, options.functions, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            keys, edges = shingles(piece["text"], options.shingle)
            size = np.diff(edges)
            filled = np.flatnonzero(size)
            minima = np.zeros((piece.num_rows, options.functions), np.uint16)
            for i in range(options.functions if len(filled) else 0):
                low = np.minimum.reduceat((keys ^ salt[i]) * factor[i], edges[:-1][filled])
                minima[filled, i] = (W.mix(low) >> W.U64(48)).astype(np.uint16)
            marks = [_sums(W.mix(keys), edges), _sums(W.mix(keys ^ W.U64(0xA5A5A5A5A5A5A5A5)), edges)]
            columns = [pa.array(size, pa.int64()), *[pa.array(m, pa.int64()) for m in marks]]
            # Big-endian bytes sort as the numbers do.
            sketch = pa.array([row.tobytes() for row in minima.astype(">u2")], pa.binary())
            yield pa.RecordBatch.from_arrays([piece["doc_id"], *columns, sketch], ["doc_id", "n_shingles", "mark", "mark2", "sketch"])

    return run


def _tree_rows(options: Options):
    m = options.functions
    columns = [(options.least * t + np.arange(options.full)) % m for t in range(options.trees)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                piece = batch.slice(k, 2000)
                minima = np.frombuffer(b"".join(piece["sketch"].to_pylist()), ">u2").reshape(piece.num_rows, m)
                paths = [row.tobytes() for c in columns for row in minima[:, c]]
                tree = np.repeat(np.arange(options.trees), piece.num_rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(tree, pa.int32()), pa.array(paths, pa.binary()),
                    pa.concat_arrays([piece["doc_id"]] * options.trees), pa.concat_arrays([piece["n_shingles"]] * options.trees),
                ], ["tree", "path", "doc_id", "n_shingles"])

    return run


def _neighbours(tree: np.ndarray, paths: np.ndarray, ids: np.ndarray, sizes: np.ndarray, options: Options) -> tuple[np.ndarray, np.ndarray]:
    """The candidate pairs of sorted rows whose sizes allow the similarity."""
    n = len(ids)
    if n < 2:
        return ids[:0], ids[:0]
    same = (paths[1:] == paths[:-1]) & (tree[1:] == tree[:-1])[:, None]
    common = np.cumprod(same, axis=1).sum(axis=1)
    region, room = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    offset = 0
    for depth in range(options.least, options.full + 1):
        number = np.concatenate([[0], np.cumsum(common < depth)])
        size = np.bincount(number)[number]
        small = size <= options.region
        final = (region < 0) & (small | (depth == options.full))
        region[final] = offset + number[final]
        room[final] = np.where(small[final], options.region - 1, options.chain)
        offset += int(number[-1]) + 1
        if (region >= 0).all():
            break
    a, b = [], []
    for step in range(1, max(options.region, options.chain + 1)):
        i = np.flatnonzero((region[step:] == region[:-step]) & (room[:-step] >= step))
        low, high = np.minimum(sizes[i], sizes[i + step]), np.maximum(sizes[i], sizes[i + step])
        i = i[100 * low >= options.percent * high]
        a.append(np.minimum(ids[i], ids[i + step]))
        b.append(np.maximum(ids[i], ids[i + step]))
    return np.concatenate(a), np.concatenate(b)


def _wide(tree: np.ndarray, paths: np.ndarray, options: Options) -> np.ndarray:
    """The sorted rows whose region at the least depth is too large, or may go on in another partition."""
    key = paths[:, :options.least]
    number = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1) | (tree[1:] != tree[:-1]))])
    return np.flatnonzero((np.bincount(number)[number] > options.region) | (number == 0) | (number == number[-1]))


PAIRS = "a long, b long, tree int, path binary, doc_id long, n_shingles long, wide boolean"


def _pair_rows(options: Options, ends: bool):
    """Candidate pairs of a sorted partition, and with ``ends`` its first and last rows, which may belong to a cut region, and the rows of wide regions."""
    names = [c.split()[0] for c in PAIRS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        paths = np.frombuffer(b"".join(rows["path"].to_pylist()), ">u2").reshape(rows.num_rows, options.full)
        tree, ids, sizes = (rows[c].to_numpy() for c in ("tree", "doc_id", "n_shingles"))
        a, b = _neighbours(tree, paths, ids, sizes, options)
        pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        empty = len(pairs)
        yield pa.RecordBatch.from_arrays([
            pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64()), pa.nulls(empty, pa.int32()),
            pa.nulls(empty, pa.binary()), pa.nulls(empty, pa.int64()), pa.nulls(empty, pa.int64()), pa.nulls(empty, pa.bool_()),
        ], names)
        if ends:
            k = options.region
            at = np.unique(np.concatenate([np.arange(min(k, rows.num_rows)), np.arange(max(0, rows.num_rows - k), rows.num_rows)]))
            edge = rows.take(pa.array(at)).combine_chunks().to_batches()[0]
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *[edge[c] for c in names[2:6]], pa.array(np.zeros(len(at), bool))], names)
            at = _wide(tree, paths, options)
            keys = pa.array([row.tobytes() for row in paths[at, :options.least]], pa.binary())
            none = pa.nulls(len(at), pa.int64())
            columns = [pa.array(tree[at], pa.int32()), keys, pa.array(ids[at], pa.int64()), pa.array(sizes[at], pa.int64()), pa.array(np.ones(len(at), bool))]
            yield pa.RecordBatch.from_arrays([none, none, *columns], names)

    return run


def candidates(sketches: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs a < b of neighbours in any tree; (tree, path, doc_id, n_shingles) of the rows in wide regions."""
    order = ["tree", "path", "doc_id"]
    rows = importable(sketches).mapInArrow(_tree_rows(options), "tree int, path binary, doc_id long, n_shingles long")
    dealt = rows.repartitionByRange(tasks(rows), *order).sortWithinPartitions(*order)
    found = settle(dealt.mapInArrow(_pair_rows(options, True), PAIRS), "near-neighbours")
    # A few rows of each task: the neighbours on both sides of every cut.
    cut = found.filter("not wide").select(*order, "n_shingles").repartitionByRange(1, *order).sortWithinPartitions(*order)
    across = importable(cut).mapInArrow(_pair_rows(options, False), PAIRS)
    pairs = found.filter(F.col("a").isNotNull()).select("a", "b").unionByName(across.select("a", "b"))
    return settle(pairs.distinct(), "near-candidates"), found.filter("wide").select(*order, "n_shingles")


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            keys, edges = shingles(piece["text"], size)
            sets = pa.array([keys[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([piece["doc_id"], sets], ["doc_id", "members"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                one, two = (np.frombuffer(batch[c][k].as_buffer(), np.uint64) for c in ("one", "two"))
                both = len(np.intersect1d(one, two, assume_unique=True))
                good[k] = 100 * both >= percent * (len(one) + len(two) - both)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(good))

    return run


def sets_of(docs: DataFrame, ids: DataFrame, options: Options) -> DataFrame:
    """(doc_id, members): the full sets of the documents in the column ``asked``."""
    texts = text_rows(docs).join(ids.distinct().hint("shuffle_hash"), F.col("doc_id") == F.col("asked")).select("doc_id", "text")
    sets = texts.mapInArrow(_set_rows(options.shingle), "doc_id long, members binary").dropDuplicates(["doc_id"])
    return settle(sets, "near-sets")


def confirmed(docs: DataFrame, pairs: DataFrame, options: Options) -> DataFrame:
    """The pairs whose full sets are similar enough. A document is in few pairs, so no key is heavy."""
    sets = sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("asked")), options)
    left = pairs.hint("shuffle_hash").join(sets.select(F.col("doc_id").alias("a"), F.col("members").alias("one")), "a")
    both = left.join(sets.hint("shuffle_hash").select(F.col("doc_id").alias("b"), F.col("members").alias("two")), "b")
    return settle(importable(both).select("a", "b", "one", "two").mapInArrow(_confirm(options.percent), "a long, b long"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of the links with the smallest node it reaches.

    Large stars hang all greater neighbours of a node on its smallest one, small
    stars the others; repeated until nothing changes, every tree is a star.
    Each round is written, and the counts that tell the end are one row each.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        return settle(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low")), "near-low")

    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "near-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = smallest(both).withColumnRenamed("u", "n")
        large = both.join(low, both["u"] == low["n"]).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = settle(large.filter("u <> v").distinct(), "near-large")
        low = smallest(large).withColumnRenamed("u", "n")
        hung = large.join(low, large["u"] == low["n"])
        small = hung.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct(F.col("u").alias("u"), F.col("low").alias("v")))).alias("e"))
        edges = settle(small.select("e.u", "e.v").filter("u <> v").distinct(), "near-edges")
        state = edges.agg(F.count("*"), F.sum("v"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state


def _overlaps(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many shingles any two of n sets share: common shingles by a product of matrices, others pair by pair."""
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    many = np.diff(np.append(starts, len(keys)))
    out = np.zeros((n, n), np.float32)
    common = many > max(16, n // 32)
    number = np.repeat(np.where(common, np.cumsum(common) - 1, -1), many)
    for k in range(0, int(common.sum()), 1024):
        at = np.flatnonzero((number >= k) & (number < k + 1024))
        held = np.zeros((n, 1024), np.float32)
        held[owner[at], number[at] - k] = 1
        out += held @ held.T
    at = np.flatnonzero(number < 0)
    left = (np.repeat(starts + many, many) - np.arange(len(keys)) - 1)[at]
    for step in range(1, int(left.max(initial=0)) + 1):  # a set holds a shingle once, so no pair stands twice in a key
        i = at[left >= step]
        pair, times = np.unique(owner[i] * n + owner[i + step], return_counts=True)
        out.reshape(-1)[pair] += times
    return out


def _link(percent: int):
    """The linked components of two blocks of a region, or of a block with itself: (a, b)."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        component, side = rows["component"].to_numpy(), rows["side"].to_numpy()
        a = b = component[:0]
        if len(component) > 1 and (component != component[0]).any():
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for c in rows["members"].chunks for v in c]
            sizes = np.array([len(s) for s in sets], np.int64)
            both = _overlaps(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
            both = np.triu(both, 1)
            one, two = np.nonzero(both)
            both = both[one, two].astype(np.int64)
            good = 100 * both >= percent * (sizes[one] + sizes[two] - both)
            good &= component[one] != component[two]
            if rows["i"][0].as_py() != rows["j"][0].as_py():
                good &= side[one] != side[two]
            a, b = component[one[good]], component[two[good]]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return run


def across_components(docs: DataFrame, wide: DataFrame, found: DataFrame, options: Options) -> DataFrame:
    """Links (a, b) between components that meet in a wide region.

    All rows of a region are compared on full sets, unless they are in one
    component already. A region is cut into blocks of a bounded number of rows
    and shingles, and every two blocks meet. Its largest components have blocks
    of their own, which need not meet each other; the others share theirs.
    """
    region = ["tree", "path"]
    named = wide.join(found.hint("shuffle_hash"), F.col("doc_id") == F.col("node"), "left")
    named = settle(named.select(*region, "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component")).distinct(), "near-wide")
    parts = named.groupBy(*region, "component").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("total"))
    parts = settle(parts, "near-parts")

    def cut(docs, total):
        return F.greatest(F.lit(1), F.ceil(docs / options.rows), F.ceil(total / options.block)).cast("long")

    own = parts.withColumn("blocks", cut(F.col("docs"), F.col("total"))).filter("blocks > 1")
    rank = F.row_number().over(Window.partitionBy(*region).orderBy(F.desc("blocks"), "component"))
    own = settle(own.withColumn("rank", rank).filter(F.col("rank") <= options.largest), "near-own")
    zones = own.groupBy(*region).agg(
        F.sort_array(F.collect_list(F.struct("rank", "component", "blocks"))).alias("own"), F.sum("docs").alias("own_docs"), F.sum("total").alias("own_total")
    )
    sizes = parts.groupBy(*region).agg(F.count("*").alias("components"), F.sum("docs").alias("docs"), F.sum("total").alias("total")).filter("components > 1")
    sizes = sizes.join(zones, region, "left")
    rest = cut(F.col("docs") - F.coalesce("own_docs", F.lit(0)), F.col("total") - F.coalesce("own_total", F.lit(0)))
    none = F.array().cast("array<long>")
    sizes = settle(sizes.select(
        *region, F.coalesce(F.col("own.component"), none).alias("owners"), F.concat(F.array(rest), F.coalesce(F.col("own.blocks"), none)).alias("blocks")
    ), "near-zones")
    # A row's zone is 0 for the shared blocks, or its component's own; it goes to every block that its own one must meet.
    placed = named.join(sizes.hint("shuffle_hash"), region).withColumn("zone", F.array_position("owners", F.col("component")))
    mine = F.col("zone") * F.lit(1 << 32) + F.pmod(F.xxhash64("doc_id"), F.element_at("blocks", (F.col("zone") + 1).cast("int")))
    count = F.transform("blocks", lambda b, k: F.transform(F.sequence(F.lit(0).cast("long"), b - 1), lambda m: k.cast("long") * F.lit(1 << 32) + m))
    placed = placed.withColumn("mine", mine).withColumn("other", F.explode(F.flatten(count)))
    placed = placed.filter("zone = 0 or zone <> other div 4294967296")
    placed = placed.select(
        *region, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") < F.col("other")).alias("side"), F.col("doc_id").alias("asked"), "component",
    )
    placed = settle(placed, "near-placed")
    sets = sets_of(docs, placed.select("asked"), options).withColumnRenamed("doc_id", "asked")
    rows = placed.join(sets.hint("shuffle_hash"), "asked").select(*region, "i", "j", "side", "component", "members")
    met = importable(rows).groupBy(*region, "i", "j").applyInArrow(_link(options.percent), "a long, b long")
    return settle(met.distinct(), "near-across")


def group(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each document."""
    rows = settle(text_rows(docs).mapInArrow(_sketch(options), "doc_id long, n_shingles long, mark long, mark2 long, sketch binary"), "near-sketches")
    known = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = settle(known.groupBy("mark", "mark2", "n_shingles").agg(F.min("doc_id").alias("first")), "near-classes")
    firsts = known.join(classes.select("first").hint("shuffle_hash"), F.col("doc_id") == F.col("first"), "left_semi").dropDuplicates(["doc_id"])
    pairs, wide = candidates(firsts.select("doc_id", "n_shingles", "sketch"), options)
    found = components(confirmed(docs, pairs, options))
    joined = components(across_components(docs, wide, found, options)).toDF("part", "whole")
    named = classes.join(found.hint("shuffle_hash"), F.col("first") == F.col("node"), "left").withColumn("near", F.coalesce("component", "first"))
    named = named.join(joined.hint("shuffle_hash"), F.col("near") == F.col("part"), "left").select(
        F.col("mark").alias("m"), F.col("mark2").alias("m2"), F.col("n_shingles").alias("n"), F.coalesce("whole", "near").alias("class_component")
    )
    named = settle(named, "near-named")
    ids = rows.select("doc_id", "n_shingles", "mark", "mark2")
    filled = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    on = (F.col("mark") == F.col("m")) & (F.col("mark2") == F.col("m2")) & (F.col("n_shingles") == F.col("n"))
    grouped = ids.filter(filled).join(named, on).select("doc_id", "n_shingles", F.col("class_component").alias("component_id"))
    out = grouped.unionByName(ids.filter(~filled).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """One document of each group, the one with the smallest id, all columns."""
    gone = settle(group(docs, options).filter(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct(), "near-gone")
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == gone["gone"], "left_anti")
