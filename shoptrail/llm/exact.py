"""Exact dedup with two passes over Bloom filters.

A text's digest is the SHA-256 of its UTF-8 with A-Z lower-cased. The first
pass sets a few bits per digest and keeps which bits were set at least twice;
the second pass reads the digests again and asks whether all bits of one were.
Only such rows, possibly repeated, are shuffled and grouped on whole digests;
all others pass straight through as groups of one. Bits set by chance send a
few rows more to the shuffle and change no result.

A digest keeps to one block of bits, found by its leading bytes, so a filter is
built block by block, each from the places that tasks have set: a text in a
third of all rows comes to a block twice per task at most. Filters of more than
``slice_bits`` are built and asked in slices, ranges of digests; the table of
digests is sorted within its files, so that a slice reads its pages only. No
more than one slice's bits are ever sent to the driver and to executors.

Defined cases: a null text counts as empty, so null and empty texts are equal.
Of equal texts the row with the largest id stays, a null id being the smallest;
if several rows of a group share that id, one of them stays. Extra columns are
not read by ``groups`` and are kept by ``keep_one``, whatever their names.
Very long texts are hashed whole. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.tables import importable, settle
from shoptrail.session import work_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A block has 2 ** 16 bits, so two bytes of a digest name a place in it.
BLOCK = 1 << 16
FLUSH_ROWS = 500_000


@dataclass(frozen=True)
class Options:
    """bits of the filter per row, places set per digest (12 at most), and most bits of a slice (16 MB)."""

    bits: int = 16
    places: int = 4
    slice_bits: int = 1 << 27


@dataclass(frozen=True)
class Layout:
    """How digests fall into blocks, and blocks into slices."""

    blocks: int
    per_slice: int
    places: int

    @staticmethod
    def of(rows: int, options: Options) -> Layout:
        blocks = max(1, -(-rows * options.bits // BLOCK))
        return Layout(blocks, min(blocks, max(1, options.slice_bits // BLOCK)), options.places)

    def slices(self) -> range:
        return range(0, self.blocks, self.per_slice)

    def block(self, digests: np.ndarray) -> np.ndarray:
        """By the four leading bytes, in their order."""
        lead = digests[:, :4].copy().view(">u4").ravel().astype(np.uint64)
        return ((lead * np.uint64(self.blocks)) >> np.uint64(32)).astype(np.int64)

    def place(self, digests: np.ndarray) -> np.ndarray:
        """The places of each digest within its block."""
        return digests[:, 8:8 + 2 * self.places].copy().view("<u2").astype(np.int64)

    def within(self, start: int, digest: Column) -> Column:
        """Whether a digest lies in the slice that begins at a block; a range, which the scan can use."""
        low, high = (-(-(k << 32) // self.blocks) for k in (start, min(self.blocks, start + self.per_slice)))
        held = digest >= F.lit(low.to_bytes(4, "big"))
        return held if high >= 1 << 32 else held & (digest < F.lit(high.to_bytes(4, "big")))


def normal(text: Column) -> Column:
    """Lower-cased A-Z only; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normal(text).cast("binary"), 256))


def _matrix(column: pa.Array) -> np.ndarray:
    """Digests of 32 bytes as rows of a matrix."""
    _, _, data = column.buffers()
    at = column.offset * 32
    return np.frombuffer(data, np.uint8)[at:at + len(column) * 32].reshape(-1, 32) if len(column) else np.zeros((0, 32), np.uint8)


def _set_places(layout: Layout):
    """Per block: the places set once and those set more often by the rows of this task."""
    def rows(digests: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(digests)
        keys, counts = np.unique((layout.block(every)[:, None] * BLOCK + layout.place(every)).ravel(), return_counts=True)
        block, place = keys // BLOCK, (keys % BLOCK).astype("<u2")
        found, first = np.unique(block, return_index=True)
        once, twice = [], []
        for a, b in zip(first, [*first[1:], len(keys)], strict=True):
            several = counts[a:b] > 1
            once.append(place[a:b][~several].tobytes())
            twice.append(place[a:b][several].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["block", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(_matrix(batch["digest"]))
            n += batch.num_rows
            if n >= FLUSH_ROWS:
                yield rows(held)
                held, n = [], 0
        if n:
            yield rows(held)

    return run


def _merge(table: pa.Table) -> pa.Table:
    """The bits of one block that were set at least twice."""
    once, twice = (np.frombuffer(b"".join(table[c].to_pylist()), "<u2") for c in ("once", "twice"))
    several = np.bincount(once, minlength=BLOCK) > 1
    several[twice] = True
    return pa.table({"block": table["block"][:1], "bits": pa.array([np.packbits(several, bitorder="little").tobytes()], pa.binary())})


def _asked(layout: Layout, bits: np.ndarray, start: int, digests: np.ndarray) -> np.ndarray:
    """Whether all bits of each digest are set."""
    place = layout.place(digests) + (layout.block(digests) - start)[:, None] * BLOCK
    return ((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).all(axis=1)


def _bits(spark, parts: DataFrame, layout: Layout, start: int):
    """One slice's bits, of at most ``slice_bits``, for all executors."""
    size = min(layout.blocks - start, layout.per_slice)
    bits = np.zeros((size, BLOCK // 8), np.uint8)
    for row in parts.toLocalIterator():
        bits[row["block"] - start] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(bits.ravel())


def _mark(layout: Layout, shared, start: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = _asked(layout, shared.value, start, _matrix(batch["digest"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flags)], [*batch.schema.names, "maybe"])

    return run


def possibly_repeated(digests: DataFrame, options: Options = Options()) -> DataFrame:
    """A table with a column ``digest``, and ``maybe``: false if no other row has it, else most likely true."""
    spark = digests.sparkSession
    kept = work_path(spark, "exact-digests")
    # Small pages of sorted digests: a slice reads the pages it needs.
    importable(digests).sortWithinPartitions("digest").write.option("parquet.page.row.count.limit", "2000").parquet(kept)
    stored = spark.read.schema(digests.schema).parquet(kept)
    layout = Layout.of(stored.count(), options)
    marked, schema = work_path(spark, "exact-marked"), stored.withColumn("maybe", F.lit(True)).schema
    for start in layout.slices():
        part = stored.filter(layout.within(start, F.col("digest"))) if layout.per_slice < layout.blocks else stored
        places = part.select("digest").mapInArrow(_set_places(layout), "block long, once binary, twice binary")
        shared = _bits(spark, places.groupBy("block").applyInArrow(_merge, "block long, bits binary"), layout, start)
        part.mapInArrow(_mark(layout, shared, start), schema).write.mode("append").parquet(marked)
        shared.unpersist()
    return spark.read.schema(schema).parquet(marked)


def _repeated(marked: DataFrame) -> DataFrame:
    """The digests of several rows: the row that stays and the number of rows. Counted where they are read, then grouped."""
    found = marked.filter("maybe").groupBy(F.col("digest").alias("of")).agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("n"))
    return settle(found.filter("n > 1"), "exact-groups")


def _digests(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), digest(F.col("text")).alias("digest"))


def groups(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """Per row: doc_id, keep_id (of the equal row that stays), group_size, kept, text_sha256."""
    marked = possibly_repeated(_digests(docs), options)
    name = F.lower(F.hex("digest")).alias("text_sha256")
    alone = marked.filter(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), name)
    several = marked.filter("maybe").join(_repeated(marked), F.col("digest") == F.col("of"), "left")
    single = F.col("n").isNull()
    return alone.unionByName(several.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep.row"))).alias("kept"),
        name,
    ))


def keep_one(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """The documents without repeated texts, all columns as they came.

    Repeated digests alone make a filter of one slice at most, so its size is
    bounded whatever their number; rows that it lets through are not shuffled.
    """
    spark = docs.sparkSession
    repeated = _repeated(possibly_repeated(_digests(docs), options))
    n = repeated.count()
    layout = Layout.of(min(n, options.slice_bits // options.bits), options)
    places = importable(repeated).select(F.col("of").alias("digest")).mapInArrow(_set_places(layout), "block long, once binary, twice binary")
    any_place = places.select("block", "once", F.concat("once", "twice").alias("twice"))
    shared = _bits(spark, any_place.groupBy("block").applyInArrow(_merge, "block long, bits binary"), layout, 0)
    rows = docs.select(F.struct("*").alias("doc"), digest(F.col("text")).alias("digest"))
    marked = rows.mapInArrow(_mark(layout, shared, 0), rows.withColumn("maybe", F.lit(True)).schema)
    asked = marked.filter("maybe").join(repeated, F.col("digest") == F.col("of"), "left")
    # A row that stays has the group's largest id; rows that share that id are reduced to one.
    stays = asked.filter(F.col("n").isNotNull() & F.col("doc.doc_id").cast("long").eqNullSafe(F.col("keep.doc_id"))).dropDuplicates(["digest"])
    out = marked.filter(~F.col("maybe")).select("doc").unionByName(asked.filter(F.col("n").isNull()).select("doc")).unionByName(stays.select("doc"))
    return out.select("doc.*")
