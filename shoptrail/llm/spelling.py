"""Grouping spelling variants with k-d trees over letter counts.

A word is a point: how often it has each letter, letters other than a-z dealt
over a few more axes. One inserted, deleted or replaced letter moves a point by
one step on one axis or by one down and one up, so words one edit apart differ
by at most two in L1 distance. Words of one length are a tree; a word looks for
replacements in the tree of its length and for insertions in that of the next,
which covers every pair of lengths once. A search leaves out all boxes that the
allowed steps do not reach; what it finds is verified letter by letter.

The tops of the trees are fitted on a bounded sample of words and cut the space
into cells. Every word goes to its cell, and as a search to each cell that it can
reach, so the cells are searched apart, each with a tree of its own. The sample
decides where the cuts are, never what is found. A cell of too many words is
dealt into parts, each searched by all that come to the cell.

Defined cases: a null or empty text has no words. A run of letters counts as
often as it stands in texts, so repeated rows count again. Of near words with
the largest count the first in code-point order is the form; no form leads to a
word of equal or smaller count, so following forms ends. Rows without id take
part, with an empty id in what is hashed. Extra columns are not read. An empty
table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm import words as W
from shoptrail.llm.tables import importable, settle, text_rows

AXES = 40  # a to z, and 14 for all other letters
LEAF = 64  # words of a leaf within a cell
CUT_ROWS = 1_000  # a cut is chosen from so many points if they differ
KEPT_WORDS = 200_000  # counted in a task before they are sent on
STRIP = 20_000  # searches of a cell at a time
PAIRS = 1 << 20  # and pairs that are compared at a time

# By id: what a run of a document counts as.
Spell = Callable[[str], Callable[[str], str]]


@dataclass(frozen=True)
class Options:
    """letters and occurrences a word has at least; how much more often a form stands than its variant;
    words the trees' tops are fitted on at most, words a cell has there at most, and words of a part of a cell."""

    letters: int = 7
    times: int = 2
    ratio: int = 10
    sample: int = 50_000
    cell: int = 4_000
    part: int = 50_000

    def __post_init__(self):
        if self.ratio < 2:
            raise ValueError("a form stands more often than its variant, or chains of forms need not end")


def as_written(doc_id: str) -> Callable[[str], str]:
    return lambda run: run


def with_slips(doc_id: str) -> Callable[[str], str]:
    """One run in 31, by hash of id and run, loses a letter."""
    begun = zlib.crc32(f"{doc_id}:".encode())

    def spell(run: str) -> str:
        h = zlib.crc32(run.encode(), begun)
        if h % 31:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]

    return spell


def letter_runs(texts: pa.Array, letters: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, A-Z lower-cased, and where maximal runs of so many letters at least begin and end, and their text.

    Letters are a-z and U+00C0 to U+00FF, whose two bytes in UTF-8 are 0xC3 and one more.
    """
    data, offsets = W.buffers(texts)
    data = W.LOWER[data]
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    inside = ((data >= 97) & (data < 123)) | second
    inside[:-1] |= second[1:]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    seconds = np.concatenate([[0], np.cumsum(second, dtype=np.int64)])
    long = ends - starts - (seconds[ends] - seconds[starts]) >= letters
    starts, ends = starts[long], ends[long]
    return data.tobytes(), starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _count(letters: int, spell: Spell):
    def batch_of(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for piece in W.chunks(batches):
            data, starts, ends, of = letter_runs(piece["text"], letters)
            names, at, spelled = piece["doc_id"].to_pylist(), -1, None
            for a, b, i in zip(starts.tolist(), ends.tolist(), of.tolist(), strict=True):
                if i != at:
                    at, spelled = i, spell("" if names[i] is None else str(names[i]))
                word = spelled(data[a:b].decode())
                if len(word) >= letters:
                    counts[word] = counts.get(word, 0) + 1
            if len(counts) >= KEPT_WORDS:
                yield batch_of(counts)
                counts = {}
        if counts:
            yield batch_of(counts)

    return run


def vocabulary(docs: DataFrame, options: Options = Options(), spell: Spell = as_written) -> DataFrame:
    """word and n: all words with letters enough that stand often enough, counted in the tasks first."""
    counts = text_rows(docs).mapInArrow(_count(options.letters, spell), "word string, n long")
    return settle(counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= options.times), "spelling-words")


def axis_of(codes: np.ndarray) -> np.ndarray:
    return np.where((codes >= 97) & (codes < 123), codes - 97, 26 + codes % (AXES - 26)).astype(np.int64)


@dataclass
class Spelled:
    """Words of one length as code points, as points, and as marks: a bit for each letter's first, second and third time."""

    codes: np.ndarray
    points: np.ndarray
    marks: np.ndarray

    @staticmethod
    def of(words: list[str], length: int) -> Spelled:
        n = len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, length)
        points = np.zeros((n, AXES), np.int32)
        for k in range(0, n, STRIP):
            part = axis_of(codes[k:k + STRIP]) + AXES * np.arange(len(codes[k:k + STRIP]))[:, None]
            points[k:k + STRIP] = np.bincount(part.ravel(), minlength=len(part) * AXES).reshape(-1, AXES)
        bits = np.zeros((n, 128), bool)
        for times in range(3):
            bits[:, times * AXES:(times + 1) * AXES] = points > times
        return Spelled(codes, points if length > 127 else points.astype(np.int8), np.packbits(bits, axis=1).view(np.uint64))


@dataclass
class Tree:
    """Nodes cut their points at one axis: up to ``cut`` on the left. A leaf has axis -1 and a number."""

    axis: list[int]
    cut: list[int]
    left: list[int]
    right: list[int]
    leaf: list[int]
    leaves: int = 0

    @staticmethod
    def fit(points: np.ndarray, size: int) -> tuple[Tree, np.ndarray]:
        """A tree whose leaves have so many points at most, unless they are equal; and each point's leaf."""
        tree, place = Tree([], [], [], [], []), np.zeros(len(points), np.int64)
        todo = [(np.arange(len(points)), -1, False)]
        while todo:
            rows, above, is_right = todo.pop()
            at = len(tree.axis)
            if above >= 0:
                (tree.right if is_right else tree.left)[above] = at
            axis, cut = _cut(points[rows]) if len(rows) > size else (-1, 0)
            for values, value in ((tree.axis, axis), (tree.cut, cut), (tree.left, -1), (tree.right, -1), (tree.leaf, -1)):
                values.append(value)
            if axis < 0:
                tree.leaf[at] = tree.leaves
                place[rows] = tree.leaves
                tree.leaves += 1
                continue
            low = points[rows, axis] <= cut
            todo += [(rows[~low], at, True), (rows[low], at, False)]
        return tree, place

    def reached(self, points: np.ndarray, steps: str) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of points and leaves whose box the steps can reach: "none", one "up" (a letter more), or one up and one down ("both").

        With both, the step up is on a later axis than the step down: of two words that differ so,
        one finds the other, and a search leaves out half of the boxes at two steps.
        """
        found_rows, found_leaves = [], []
        n = len(points)
        none = np.full(n, -1, np.int8)
        todo = [(0, np.arange(n), none, none)]
        while todo:
            at, rows, down, up = todo.pop()
            axis = self.axis[at]
            if axis < 0:
                found_rows.append(rows)
                found_leaves.append(np.full(len(rows), self.leaf[at], np.int64))
                continue
            value, cut = points[rows, axis], self.cut[at]
            left, right = value <= cut, value > cut
            if steps != "none":
                rises = (value == cut) & ((up == axis) | ((up < 0) & (down < axis)))
                todo_right = (right | rises, rises)
            else:
                todo_right = (right, None)
            if steps == "both":
                sinks = (value == cut + 1) & ((down == axis) | ((down < 0) & ((up < 0) | (up > axis))))
                todo_left = (left | sinks, sinks)
            else:
                todo_left = (left, None)
            go, paid = todo_right
            if go.any():
                todo.append((self.right[at], rows[go], down[go], (up if paid is None else np.where(paid, np.int8(axis), up))[go]))
            go, paid = todo_left
            if go.any():
                todo.append((self.left[at], rows[go], (down if paid is None else np.where(paid, np.int8(axis), down))[go], up[go]))
        return (np.concatenate(found_rows), np.concatenate(found_leaves)) if found_rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _cut(points: np.ndarray) -> tuple[int, int]:
    """The axis and value that part the points, or the first of them, most evenly; -1 if all are equal."""
    for some in (points[:CUT_ROWS], points):
        low, high = some.min(axis=0), some.max(axis=0)
        axes = np.flatnonzero(high > low)
        if not len(axes):
            continue
        best, at = 0, (-1, 0)
        for cut in np.unique(np.concatenate([low[axes], high[axes] - 1])):
            upto = (some[:, axes] <= cut).sum(axis=0, dtype=np.int64)
            even = np.minimum(upto, len(some) - upto)
            k = int(even.argmax())
            if even[k] > best:
                best, at = int(even[k]), (int(axes[k]), int(cut))
        return at
    return -1, 0


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether leaving out one letter of each longer word gives the shorter one."""
    n, length = short.shape
    same = short == long[:, :length]
    head = np.where(same.all(axis=1), length, same.argmin(axis=1))  # letters equal from the start
    moved = short == long[:, 1:]
    tail = np.where(moved.all(axis=1), length, moved[:, ::-1].argmin(axis=1))  # and from the end
    return head + tail >= length


def in_order(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Of words with one letter replaced: whether the member's letter is later, by axis and code, so that one of two finds the other."""
    at = (short != long).argmax(axis=1)
    rows = np.arange(len(at))
    a, b = short[rows, at], long[rows, at]
    return (axis_of(a) < axis_of(b)) | ((axis_of(a) == axis_of(b)) & (a < b))


def near_pairs(searches: Spelled, members: Spelled, same_length: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of searched words and of members that are one edit apart, each pair once: a later letter, or a letter more, in the member."""
    if not len(members.codes) or not len(searches.codes):
        return
    tree, place = Tree.fit(members.points, LEAF)
    order = np.argsort(place, kind="stable")
    edges = np.searchsorted(place[order], np.arange(tree.leaves + 1))
    most = 2 if same_length else 1
    for k in range(0, len(searches.codes), STRIP):
        rows, leaves = tree.reached(searches.points[k:k + STRIP], "both" if same_length else "up")
        many = edges[leaves + 1] - edges[leaves]
        parts = np.searchsorted(np.cumsum(many), np.arange(PAIRS, many.sum() + PAIRS, PAIRS), side="left") + 1
        for p, q in zip([0, *parts[:-1]], parts, strict=True):
            r, leaf, size = rows[p:q] + k, leaves[p:q], many[p:q]
            a = np.repeat(r, size)
            b = order[np.repeat(edges[leaf] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            # Letters up to the third time differ in as many marks: cheap, and never more than the points do.
            apart = np.bitwise_count(searches.marks[a, 0] ^ members.marks[b, 0]) + np.bitwise_count(searches.marks[a, 1] ^ members.marks[b, 1])
            close = apart <= most
            a, b = a[close], b[close]
            short, long = searches.codes[a], members.codes[b]
            verified = one_replaced(short, long) if same_length else one_inserted(short, long)
            a, b = a[verified], b[verified]
            if same_length:
                ordered = in_order(searches.codes[a], members.codes[b])
                a, b = a[ordered], b[ordered]
            yield a, b


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


def _route(trees: dict[int, Tree], parts: dict[int, np.ndarray] | None):
    """Rows by length of the members, cell and part: members once, and searches for each cell in reach.

    ``parts`` tells by length how many parts each cell has. Without it only members' cells are told.
    """
    whole = Tree([-1], [0], [-1], [-1], [0], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch["word"].to_pylist(), batch["n"]
            for length, at in _by_length(words):
                points = Spelled.of([words[i] for i in at], length).points
                for role, (tree_of, steps) in enumerate(((length, "none"), (length, "both"), (length + 1, "up"))):
                    if role and parts is None or parts is not None and tree_of not in parts:
                        continue
                    rows, cells = trees.get(tree_of, whole).reached(points, steps)
                    many = np.ones(len(cells), np.int64) if parts is None else parts[tree_of][cells]
                    if role:  # to every part of the cell; to none if it has no members
                        rows, cells = np.repeat(rows, many), np.repeat(cells, many)
                        part = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
                    else:
                        part = np.fromiter((zlib.crc32(words[at[r]].encode()) for r in rows), np.int64, len(rows)) % np.maximum(many, 1)
                    for k in range(0, len(rows), 50_000):
                        s = slice(k, k + 50_000)
                        took = pa.array(at[rows[s]])
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(took), tree_of), pa.int32()), pa.array(cells[s], pa.int32()), pa.array(part[s], pa.int32()), pa.array(np.full(len(took), role), pa.int8()),
                            batch["word"].take(took), counts.take(took),
                        ], ["length", "cell", "part", "role", "word", "n"])

    return run


def _search(table: pa.Table) -> pa.Table:
    """The near pairs of one part of a cell, told from both sides."""
    words, counts, role = table["word"].to_pylist(), table["n"].to_numpy(), table["role"].to_numpy()
    length = table["length"][0].as_py()
    of = [np.flatnonzero(role == r) for r in range(3)]
    members = Spelled.of([words[i] for i in of[0]], length)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for r in (1, 2):
        searches = Spelled.of([words[i] for i in of[r]], length + 1 - r)
        for a, b in near_pairs(searches, members, r == 1):
            left += [of[r][a], of[0][b]]
            right += [of[0][b], of[r][a]]
    left, right = np.concatenate(left), np.concatenate(right)
    word = table["word"].combine_chunks()
    return pa.table({"word": word.take(pa.array(left)), "n": pa.array(counts[left]), "near": word.take(pa.array(right)), "near_n": pa.array(counts[right])})


def _tops(words: DataFrame, options: Options) -> dict[int, Tree]:
    """The tops of the trees, fitted on at most about ``sample`` words, chosen by hash."""
    total = words.count()
    share = min(1.0, options.sample / max(total, 1))
    chosen = words.filter((F.xxhash64("word") / 2.0**64 + 0.5) < share).select("word") if share < 1 else words.select("word")
    sample = [r["word"] for r in chosen.toLocalIterator()]
    # A cell has fewer words in a sample than in all.
    size = max(20, int(options.cell * share))
    return {length: Tree.fit(Spelled.of([sample[i] for i in at], length).points, size)[0] for length, at in _by_length(sample)}


def near_words(words: DataFrame, options: Options = Options()) -> DataFrame:
    """word, n, near, near_n: all pairs of words (distinct rows of word and n) that are one edit apart, from both sides."""
    trees = _tops(words, options)
    route = "length int, cell int, part int, role byte, word string, n long"
    rows = importable(words).select("word", "n")
    sizes = rows.mapInArrow(_route(trees, None), route).groupBy("length", "cell").count()
    # One entry per cell of the bounded trees.
    parts: dict[int, np.ndarray] = {}
    for r in sizes.toLocalIterator():
        cells = parts.setdefault(r["length"], np.zeros(trees[r["length"]].leaves if r["length"] in trees else 1, np.int64))
        cells[r["cell"]] = -(-r["count"] // options.part)
    routed = rows.mapInArrow(_route(trees, parts), route)
    return routed.groupBy("length", "cell", "part").applyInArrow(_search, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word and root from word and form: the last of the chain of forms, found by doubling."""
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        step = settle(known, "spelling-roots")
        further = step.select(F.col("word").alias("from"), F.col("root").alias("to"))
        known = step.join(further, F.col("root") == F.col("from"), "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved"))
        known = settle(known, "spelling-roots")
        if known.filter("moved").isEmpty():
            return known.drop("moved")
        known = known.drop("moved")


def variants(words: DataFrame, options: Options = Options()) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word (distinct rows of word and n)."""
    near = near_words(words, options).groupBy(F.col("word").alias("of"), F.col("n").alias("own")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    common = -F.col("best.less") >= options.ratio * F.col("own")
    near = settle(near.select("of", "n_near", F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")), "spelling-near")
    last = roots(near.filter("form is not null").select(F.col("of").alias("word"), "form")).select(F.col("word").alias("variant"), "root")
    out = words.join(near, F.col("word") == F.col("of"), "left").join(last, F.col("word") == F.col("variant"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def group(docs: DataFrame, options: Options = Options(), spell: Spell = as_written) -> DataFrame:
    """The variants among the words of documents."""
    return variants(vocabulary(docs, options, spell), options)
