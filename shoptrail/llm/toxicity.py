"""Toxicity by positive-unlabelled learning.

Confirmed toxic documents are the positives; all other text is unlabelled. A
linear classifier over the presence of words and of their beginnings is trained in numpy against the
non-negative risk estimate: the class prior times the positives' loss, plus the
unlabelled loss as negatives less the share that the positives explain, which
is never let below zero. The margins are then scaled to probabilities on the
sample's labelled rows.

Training reads a bounded sample of documents, picked by a hash of the id. Its
words that most tell positives apart are the features.

Defined cases: a null or empty text has no words and gets the score of the bias.
A document labelled twice is positive if either label says so. Without positives every score is 0. Repeated rows get equal
scores. Rows without id are scored and only ever unlabelled. An empty table gives
an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm import words as W
from shoptrail.llm.tables import importable, settle, text_rows


# Bytes of a word's beginning that are marks of their own.
BEGINNINGS = (4, 5, 6)
# Margins in the risk are cut here: a few extreme ones would swamp the difference of two losses.
BOUND = 6.0


@dataclass(frozen=True)
class Options:
    """Bounds of the sample, number of features, a feature's least documents, share of positives and ratio of rates, and the training's steps."""

    most_positive: int = 4_000
    most_unlabelled: int = 16_000
    features: int = 512
    least_docs: int = 3
    least_share: float = 0.02
    ratio: float = 2.0
    steps: int = 300
    rate: float = 0.1
    penalty: float = 1e-4
    beta: float = 0.0


@dataclass
class Model:
    """Sorted word hashes, their weights, and the bias."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -np.inf

    def scores(self, texts: pa.Array) -> np.ndarray:
        of, feature = present(texts, self.words)
        margin = self.bias + np.bincount(of, weights=self.weights[feature], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500))) if np.isfinite(self.bias) else np.zeros(len(texts))


def marks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every word and of the beginnings of longer words, so that inflected forms share a mark."""
    w = W.split(texts, W.ALNUM, lower=True)
    of = w.text_of_word()
    all_of, hashes = [of], [w.hashes]
    for size in BEGINNINGS:
        long = w.ends - w.starts > size
        all_of.append(of[long])
        hashes.append(W.byte_hash(w.data, w.starts[long], w.starts[long] + size) ^ W.U64(size))
    return np.concatenate(all_of), np.concatenate(hashes)


def present(texts: pa.Array, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every feature that stands in a text."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of, hashes = marks(texts)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    hit = words[at] == hashes
    pairs = np.unique(of[hit] * len(words) + at[hit])
    return pairs // len(words), pairs % len(words)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: remainder 2 of the id's checksum by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word, by kind, summed over the task."""
    kept, counts = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
    for piece in W.chunks(batches):
        of, hashes = marks(piece["text"])
        once = ~W.seen_before(hashes ^ W.mix(of.astype(np.uint64) + W.U64(1)))
        hashes, positive = hashes[once], piece["positive"].to_numpy(zero_copy_only=False)[of[once]].astype(np.int64)
        merged, number = np.unique(np.concatenate([kept, hashes]), return_inverse=True)
        total = np.zeros((len(merged), 2), np.int64)
        total[number[:len(kept)]] = counts
        np.add.at(total, (number[len(kept):], positive), 1)
        kept, counts = merged, total
        if len(kept) > 500_000:
            yield _word_batch(kept, counts)
            kept, counts = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
    yield _word_batch(kept, counts)


def _word_batch(words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts[:, 0]), pa.array(counts[:, 1])], ["word", "unlabelled", "positive"])


def choose_words(rows: DataFrame, options: Options) -> np.ndarray:
    """The words that most tell positives from the rest, by the gap of their document rates in standard errors."""
    sizes = {r["positive"]: r["count"] for r in rows.groupBy("positive").count().collect()}
    n1, n0 = float(sizes.get(True, 0)), float(sizes.get(False, 0))
    if not n1 or not n0:
        return np.zeros(0, np.uint64)
    found = importable(rows).select("text", "positive").mapInArrow(_word_rows, "word long, unlabelled long, positive long")
    found = found.groupBy("word").agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u"))
    rate1, rate0, rate = F.col("p") / n1, F.col("u") / n0, (F.col("p") + F.col("u")) / (n1 + n0)
    gap = (rate1 - rate0) / F.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0) + 1e-12)
    # A low estimate of the positives' rate must clear a high one of the others'.
    low, high = (F.col("p") - 1.5 * F.sqrt("p")) / n1, (F.col("u") + 1.5 * F.sqrt(F.col("u") + 1)) / n0
    told = found.filter((F.col("p") >= max(options.least_docs, options.least_share * n1)) & (low > options.ratio * high)).select("word", gap.alias("gap"))
    best = told.orderBy(F.col("gap").desc(), "word").limit(options.features).collect()
    return np.sort(np.array([r["word"] for r in best], np.int64).view(np.uint64))


def train(positive: tuple[np.ndarray, np.ndarray, int], unlabelled: tuple[np.ndarray, np.ndarray, int], features: int, prior: float, options: Options) -> tuple[np.ndarray, float]:
    """Weights and bias by full gradients with momentum; inputs are (row, feature, number of rows)."""
    weights, bias = np.zeros(features), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(features + 1), np.zeros(features + 1)
    rate1 = np.bincount(positive[1], minlength=features) / positive[2]
    rate0 = np.bincount(unlabelled[1], minlength=features) / unlabelled[2]
    weights += np.log((rate1 + 0.5 / positive[2]) / (rate0 + 0.5 / unlabelled[2])).clip(0, 4) * 0.5

    def margins(x):
        return np.clip(bias + np.bincount(x[0], weights=weights[x[1]], minlength=x[2]), -BOUND, BOUND)

    def back(x, slope):
        return np.append(np.bincount(x[1], weights=slope[x[0]], minlength=features), slope.sum()) / x[2]

    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for step in range(1, options.steps + 1):
        zp, zu = margins(positive), margins(unlabelled)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        falling = back(unlabelled, sigmoid(zu)) - prior * back(positive, sigmoid(zp))
        if negative >= -options.beta:
            slope = falling - prior * back(positive, sigmoid(-zp))
        else:  # the estimate fell below what a risk can be: only the positives' part counts
            slope = -prior * back(positive, sigmoid(-zp))
        slope[:-1] += options.penalty * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        move = options.rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, bias


def calibrate(positive: np.ndarray, clean: np.ndarray, prior: float, steps: int = 50) -> tuple[float, float]:
    """(scale, shift) that turn margins of labelled rows into probabilities (Newton steps, lightly damped)."""
    if not len(positive) or not len(clean):
        return 1.0, 0.0
    z = np.concatenate([positive, clean])
    y = np.concatenate([np.ones(len(positive)), np.zeros(len(clean))])
    weight = np.concatenate([np.full(len(positive), prior / len(positive)), np.full(len(clean), (1 - prior) / len(clean))])
    x, theta = np.stack([z, np.ones(len(z))]), np.array([1.0, 0.0])
    ridge = np.diag([1e-3, 1e-4])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        slope = x @ (weight * (p - y)) + ridge @ (theta - np.array([1.0, 0.0]))
        curve = (x * (weight * p * (1 - p))) @ x.T + ridge
        move = np.linalg.solve(curve, slope)
        theta -= move * min(1.0, 1.0 / max(np.abs(move).max(), 1e-9))
    return max(float(theta[0]), 0.05), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, learned: Column, options: Options = Options()) -> Model:
    """A model from the rows where ``learned`` holds. The prior is the toxic share among their labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("known"), (F.col("toxic") == 1).alias("toxic")).filter("toxic is not null")
    known = known.groupBy("known").agg(F.max("toxic").alias("toxic"))
    toxic = settle(known.filter("toxic"), "toxic-known").select("known")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter(learned)
    share = known.join(ids, F.col("doc_id") == F.col("known")).agg(F.count("*").alias("n"), F.sum(F.col("toxic").cast("int")).alias("bad")).first()
    if not share["bad"] or share["bad"] == share["n"]:
        return Model()
    prior = share["bad"] / share["n"]
    order = F.xxhash64(F.lit(23), "doc_id")
    positives = ids.join(toxic, F.col("doc_id") == F.col("known"), "left_semi").distinct().orderBy(order, "doc_id").limit(options.most_positive)
    others = ids.filter("doc_id is not null").join(toxic, F.col("doc_id") == F.col("known"), "left_anti").distinct().orderBy(order, "doc_id").limit(options.most_unlabelled)
    # The sample's ids are bounded by the options, whatever the size of the corpus.
    others = others.join(known.filter(~F.col("toxic")), F.col("doc_id") == F.col("known"), "left")
    picked = positives.select("doc_id", F.lit(True).alias("positive"), F.lit(False).alias("clean"))
    picked = picked.unionByName(others.select("doc_id", F.lit(False).alias("positive"), F.col("known").isNotNull().alias("clean")))
    sample = settle(picked.withColumnRenamed("doc_id", "picked"), "toxic-sample")
    rows = text_rows(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("picked")).select("doc_id", "text", "positive", "clean")
    # Copies of a text would make its rare words look telling.
    rows = settle(rows.dropDuplicates(["text", "positive"]), "toxic-texts")
    words = choose_words(rows, options)
    if not len(words):
        return Model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            of, feature = present(piece["text"], words)
            edges = pa.array(np.searchsorted(of, np.arange(piece.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([piece["doc_id"], piece["positive"], piece["clean"], pa.ListArray.from_arrays(edges, pa.array(feature, pa.int32()))], ["doc_id", "positive", "clean", "features"])

    found = importable(rows).mapInArrow(run, "doc_id long, positive boolean, clean boolean, features array<int>").orderBy("doc_id").toArrow()

    def side(flag: str, value: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
        part = found.filter(pc.equal(found[flag], value))["features"].combine_chunks()
        lists = part if isinstance(part, pa.ListArray) else part.chunk(0)
        return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy(), len(lists)

    # Unlabelled text holds positives at the prior: the sampled ones join it in that share.
    positive, rest, clean = side("positive"), side("positive", False), side("clean")
    extra = min(positive[2], int(round(prior / (1 - prior) * rest[2])))
    chosen = positive[0] < extra
    unlabelled = (np.concatenate([rest[0], positive[0][chosen] + rest[2]]), np.concatenate([rest[1], positive[1][chosen]]), rest[2] + extra)
    weights, bias = train(positive, unlabelled, len(words), prior, options)
    margin = lambda x: bias + np.bincount(x[0], weights=weights[x[1]], minlength=x[2])
    scale, shift = calibrate(margin(positive), margin(clean), prior)
    return Model(words, weights * scale, bias * scale + shift)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score from 0 to 1 of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(model.scores(piece["text"]), pa.float64())], ["doc_id", "score"])

    return text_rows(docs).mapInArrow(run, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, options: Options = Options(), threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted; learned from the rows that are not held out."""
    out = held_out(F.col("doc_id"))
    model = fit(docs, labels, ~out, options)
    found = score(docs, model).withColumn("held_out", out)
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int")).select("doc_id", "held_out", "score", "predicted")
