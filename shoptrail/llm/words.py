"""Words, hashes and windows of whole texts as numpy arrays, for code inside tasks.

Texts are read from an Arrow column without decoding. A word is a longest run
of bytes of a class; every byte over 0x7F is a word byte, so a class of ASCII
characters is enough. Hashes are 64 bits wide: a polynomial over random byte
values, mixed. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20


def _class(separators: list[int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[separators] = False
    return table


# Words are split at white space, or at all that is no letter, digit or non-ASCII character.
SPACED = _class([0x20, *range(0x09, 0x0E)])
ALNUM = _class([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_BYTES = np.random.default_rng(20240517).integers(1, 1 << 63, 256, dtype=U64) | U64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (a 64-bit finaliser)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.empty(size, U64), np.empty(size, U64)
    for out, factor in ((up, base), (down, pow(base, -1, 1 << 64))):
        out[0] = 1
        filled = 1
        while filled < size:
            step = min(filled, size - filled)
            out[filled:filled + step] = out[:step] * U64(pow(factor, filled, 1 << 64))
            filled += step
    return up, down


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base and their inverses, modulo 2**64."""
    return _powers(base, max(1 << 16, 1 << max(size, 1).bit_length()))


@dataclass
class Words:
    """The words of several texts, one after another."""

    data: np.ndarray      # all bytes
    offsets: np.ndarray   # where each text begins in data, and the end
    starts: np.ndarray    # where each word begins in data
    ends: np.ndarray
    first: np.ndarray     # the number of each text's first word, and the end
    hashes: np.ndarray    # of each word; empty if not asked for

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have the flag."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def words_with(self, flags: np.ndarray) -> np.ndarray:
        """How many words of each text have the flag."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.first[1:]] - total[self.first[:-1]]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, where, data = texts.buffers()
    if where is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def byte_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each byte range."""
    up, down = powers(0x9E3779B97F4A7C15, len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum(_BYTES[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def split(texts: pa.Array, word_bytes: np.ndarray = SPACED, lower: bool = False, hashed: bool = True) -> Words:
    data, offsets = buffers(texts)
    if lower:
        data = LOWER[data]
    inside = word_bytes[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[filled] = inside[filled]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, first, byte_hash(data, starts, ends) if hashed else np.zeros(0, U64))


def windows(hashes: np.ndarray, first: np.ndarray, length: int, base: int = 0xD6E8FEB86659FD93) -> tuple[np.ndarray, np.ndarray]:
    """The first words of all windows of a length, none across texts, and their hashes."""
    if len(hashes) < length:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    up, down = powers(base, len(hashes) + 1)
    total = np.empty(len(hashes) + 1, U64)
    total[0] = 0
    np.cumsum(hashes * up[:len(hashes)], out=total[1:])
    stop = np.repeat(first[1:], np.diff(first))[:len(hashes) - length + 1]
    at = np.flatnonzero(np.arange(len(stop)) + length <= stop)
    return at, mix((total[at + length] - total[at]) * down[at])


def seen_before(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key stands earlier."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return out


def in_several(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key stands anywhere else."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def covered(size: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of ``size`` places lie in any of the ranges."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of about ``limit`` bytes of text, so that arrays stay small.

    A longer text is a piece of its own; it is never cut.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
