"""Hard-negative mining with Four-Russians scores.

A vector's components become integers, floor(scale * x). Rows are packed in
blocks: a block holds one byte per row, bit plane (two's complement) and group
of eight dimensions. For a set of anchors the subset sums of each group of
eight components are tabled once, 256 of them; a byte of a plane then names the
anchors' sum over the dimensions whose bit is set, and the sums, shifted by
their planes and added, are exact inner products. Nothing is estimated.

Anchors are scored against all rows in blocks: groups of anchors meet groups of
blocks by key, and each meeting returns the best few rows per anchor, not pairs.
The first pass finds an anchor's positives, the best rows of its own label; the
second finds, for each positive, the best rows of other labels whose score lies
between two percentages of the positive's.

Defined cases: rows without an id, label or vector, or with a null or non-finite
component, take no part. Ties go to the smaller id. Every row counts by itself:
rows that share an id are all candidates, an anchor is no positive of itself,
and an anchor id in several rows gives each of them its results. Vectors of
unequal length are compared as if filled up with zeros; an empty one scores 0.
Integers beyond 2 ** 62 count as that, and sums wrap at 64 bits. A negative
positive score has no negatives, since its bounds are the wrong way round. Extra
columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.tables import importable, settle

BYTES = 256  # values of eight bits
TABLE_BYTES = 16 << 20  # of the subset sums of anchors that are scored together
BLOCK_BYTES = 4 << 20  # of integers packed together
STRIP = 512  # rows whose sums are added at a time, to stay in cache

PACKED = "groups int, planes int, ids binary, labels binary, bits binary, anchors binary"
ANCHORS = "block long, at int, anchor_id long, label long, vector binary"


@dataclass(frozen=True)
class Options:
    """scale of the integers; positives and negatives wanted; percentages of the positive's score;
    rows of a block, anchors and blocks that meet in one group, and groups wanted at least."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    rows: int = 4096
    anchors: int = 2048
    blocks: int = 16
    spread: int = 16


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    big = 2.0**62
    out = np.where(np.abs(scaled) < big, scaled, 0).astype(np.int64)
    out[scaled >= big] = 1 << 62
    out[scaled <= -big] = -(1 << 62)
    return out


def _planes(numbers: np.ndarray) -> int:
    """Bits of two's complement that hold all numbers."""
    if not numbers.size:
        return 1
    return 1 + max(int(numbers.max()), -1 - int(numbers.min())).bit_length()


def pack(numbers: np.ndarray) -> np.ndarray:
    """Bytes by plane, group of eight dimensions and row, of rows of integers."""
    n, dims = numbers.shape
    out = np.zeros((_planes(numbers), -(-dims // 8), n), np.uint8)
    for p in range(len(out)):
        out[p] = np.packbits(((numbers >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def unpack(bits: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The integers of some rows."""
    planes, groups, _ = bits.shape
    out = np.zeros((len(rows), groups * 8), np.int64)
    for p in range(planes):
        plane = np.unpackbits(np.ascontiguousarray(bits[p][:, rows].T), axis=1, bitorder="little").astype(np.int64)
        out += (-plane if p == planes - 1 else plane) << p
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """By group of eight dimensions and byte: each anchor's sum over the dimensions whose bit is set."""
    n, dims = anchors.shape
    tables = np.zeros((dims // 8, BYTES, n), anchors.dtype)
    for k in range(8):
        tables[:, 1 << k:2 << k] = tables[:, :1 << k] + anchors[:, k::8].T[:, None, :]
    return tables


def scores(tables: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The inner products of anchors (their subset sums) and a block's rows: a row for each anchor."""
    planes, _, n = bits.shape
    groups = min(len(tables), bits.shape[1])  # beyond it one side is zero
    out = np.zeros((tables.shape[2], n), tables.dtype)
    for a in range(0, n, STRIP):
        strip = bits[:, :, a:a + STRIP]
        total = np.zeros((strip.shape[2], tables.shape[2]), tables.dtype)
        found = np.empty_like(total)
        for p in reversed(range(planes)):  # from the highest plane, which is negative, doubling on the way
            total <<= 1
            for g in range(groups):
                np.take(tables[g], strip[p, g], axis=0, out=found, mode="clip")
                if p == planes - 1:
                    total -= found
                else:
                    total += found
        out[:, a:a + STRIP] = total.T
    return out


def best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Of the listed rows, those of the highest scores, ties by smaller id, in order."""
    if len(rows) > most:
        least = np.partition(score[rows], len(rows) - most)[len(rows) - most]
        rows = rows[score[rows] >= least]
    # Complemented, as the least long has no negative.
    return rows[np.lexsort((ids[rows], ~score[rows]))[:most]]


def _pack_rows(options: Options):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["embedding"]
            lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
            begins = np.cumsum(lengths) - lengths
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ids, labels, chosen = (batch[c].to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "chosen"))
            for length in np.unique(lengths):
                of = np.flatnonzero(lengths == length)
                step = int(max(1, min(options.rows, BLOCK_BYTES // (8 * max(1, length)))))
                for k in range(0, len(of), step):
                    rows = of[k:k + step]
                    numbers = np.zeros((len(rows), -(-int(length) // 8) * 8), np.int64)
                    numbers[:, :length] = _integers(values[begins[rows][:, None] + np.arange(length)], options.scale)
                    bits = pack(numbers)
                    anchors = np.flatnonzero(chosen[rows]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([bits.shape[1]], pa.int32()), pa.array([bits.shape[0]], pa.int32()),
                        *[pa.array([x.tobytes()], pa.binary()) for x in (ids[rows].astype(np.int64), labels[rows].astype(np.int64), bits, anchors)],
                    ], ["groups", "planes", "ids", "labels", "bits", "anchors"])

    return run


def packed(vectors: DataFrame, anchor: Column, options: Options = Options()) -> DataFrame:
    """The rows in numbered blocks of bit planes, with the places of anchors; written once."""
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("chosen"), value.alias("embedding"))
    return settle(importable(rows).mapInArrow(_pack_rows(options), PACKED).withColumn("block", F.monotonically_increasing_id()), "negatives-blocks")


def _block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["bits"], np.uint8).reshape(row["planes"], row["groups"], len(ids))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            at = np.frombuffer(row["anchors"], np.int32)
            if not len(at):
                continue
            ids, labels, bits = _block(row)
            vectors = unpack(bits, at)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["block"]] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(ids[at], pa.int64()), pa.array(labels[at], pa.int64()),
                pa.array([v.tobytes() for v in vectors], pa.binary()),
            ], ["block", "at", "anchor_id", "label", "vector"])


def _together(anchors: list[dict]) -> Iterator[list[dict]]:
    """Anchors of one length, as many as a bounded table holds."""
    by_length: dict[int, list[dict]] = {}
    for row in anchors:
        by_length.setdefault(len(row["vector"]), []).append(row)
    for length, rows in by_length.items():
        step = max(1, min(BYTES, TABLE_BYTES // max(1, BYTES * length // 8)))
        for k in range(0, len(rows), step):
            yield rows[k:k + step]


def _meet(pick):
    """Score a group of anchors against a group of blocks; ``pick`` names the rows an anchor takes, as (slot, rows)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in ("block", "at", "slot", "score", "vec_id")}
        blocks = right.to_pylist()
        for anchors in _together(left.to_pylist()):
            whole = np.stack([np.frombuffer(a["vector"], np.int64) for a in anchors])
            exact32 = whole.shape[1] * (1 << (_planes(whole) + max((b["planes"] for b in blocks), default=0))) < 1 << 31
            tables = subset_sums(whole.astype(np.int32) if exact32 else whole)
            held: list[dict[int, list]] = [{} for _ in anchors]
            for block in blocks:
                ids, labels, bits = _block(block)
                if not len(ids):
                    continue
                for anchor, score, mine in zip(anchors, scores(tables, bits).astype(np.int64), held, strict=True):
                    own = anchor["at"] if anchor["block"] == block["block"] else -1
                    for slot, rows in pick(anchor, own, score, ids, labels):
                        mine.setdefault(slot, []).append((score[rows], ids[rows]))
            for anchor, mine in zip(anchors, held, strict=True):
                for slot, parts in mine.items():
                    score, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
                    kept = best(score, ids, np.arange(len(ids)), pick.most)
                    for name, values in (("block", [anchor["block"]] * len(kept)), ("at", [anchor["at"]] * len(kept)), ("slot", [slot] * len(kept)), ("score", score[kept]), ("vec_id", ids[kept])):
                        out[name].extend(values)
        kinds = {"at": pa.int32(), "slot": pa.int32()}
        return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    return run


class _Positives:
    """The best other rows of the anchor's label."""

    def __init__(self, most: int):
        self.most = most

    def __call__(self, anchor, own, score, ids, labels):
        rows = np.flatnonzero(labels == anchor["label"])
        rows = rows[rows != own]
        if len(rows):
            yield 0, best(score, ids, rows, self.most)


class _Negatives:
    """For each positive score, the best rows of other labels within its bounds."""

    def __init__(self, most: int, low: int, high: int):
        self.most, self.low, self.high = most, low, high

    def __call__(self, anchor, own, score, ids, labels):
        other = labels != anchor["label"]
        for slot, positive in enumerate(anchor["positives"]):
            # low * positive <= 100 * score <= high * positive, in whole numbers
            rows = np.flatnonzero(other & (score >= -(-self.low * positive // 100)) & (score <= self.high * positive // 100))
            if len(rows):
                yield slot, best(score, ids, rows, self.most)


def _all_against(anchors: DataFrame, blocks: DataFrame, pick, options: Options) -> DataFrame:
    """block, at, slot, score and vec_id of the picked rows, in order of rank.

    Each group of anchors meets each group of blocks once: anchors are sent once per group of
    blocks and blocks once per group of anchors, and a meeting's size does not follow the data.
    """
    n_anchors, n_blocks = max(1, anchors.count()), max(1, blocks.count())
    sets = -(-n_anchors // options.anchors)
    files = min(n_blocks, max(-(-n_blocks // options.blocks), -(-options.spread // sets)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("_set", F.pmod(F.xxhash64("block", "at"), F.lit(sets)).cast("int")).withColumn("_file", every(files))
    right = blocks.drop("anchors").withColumn("_file", F.pmod(F.xxhash64("block"), F.lit(files)).cast("int")).withColumn("_set", every(sets))
    met = left.groupBy("_set", "_file").cogroup(right.groupBy("_set", "_file")).applyInArrow(_meet(pick), "block long, at int, slot int, score long, vec_id long")
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("block", "at", "slot").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= pick.most)


def mine(vectors: DataFrame, anchor: Column, options: Options = Options()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the rows that ``anchor`` is true for.

    ``vectors`` has vec_id, label (a whole number) and embedding (an array of numbers).
    """
    blocks = packed(vectors, anchor, options)
    anchors = settle(blocks.mapInArrow(_anchor_rows, ANCHORS), "negatives-anchors")
    # At most ``positives`` of each anchor.
    found = _all_against(anchors, blocks, _Positives(options.positives), options).groupBy(F.col("block").alias("of"), F.col("at").alias("place")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("found")
    )
    positives = settle(found, "negatives-positives")
    asked = anchors.join(positives, (F.col("block") == F.col("of")) & (F.col("at") == F.col("place"))).withColumn("positives", F.col("found.score"))
    asked = settle(asked.drop("of", "place"), "negatives-asked")
    taken = _all_against(asked.drop("found"), blocks, _Negatives(options.negatives, options.low, options.high), options)
    names = asked.select("anchor_id", F.col("block").alias("of"), F.col("at").alias("place"), "found")
    rows = taken.join(names, (F.col("block") == F.col("of")) & (F.col("at") == F.col("place")))
    positive = F.element_at("found", F.col("slot") + 1)
    return rows.select("anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))
