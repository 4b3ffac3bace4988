"""Quality rules: statistics of whole texts, and a decision list learned from labels.

The list is learned by sequential covering. Each rule is a conjunction of
thresholds, grown on two thirds of the labelled rows by information gain,
pruned on the rest, and kept only if precise enough on both. Rules are written
as one ordered conditional expression over the statistics.

Defined cases: a null or empty text has no words and fails the base rules. A
statistic that divides by zero is 0. Without labels of both kinds no rule is
learned and the base rules decide. Repeated rows are judged alike. A document
without id is judged, but never used to learn. Extra columns of documents stay
as they are, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm import words as W
from shoptrail.llm.tables import importable, settle, text_rows

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct",
)
# What rules may look at: each is a ratio, so that it means the same for short and long texts.
FEATURES = {
    "mean_word": ("word_chars", "n_words"),
    "symbols_a_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "words_a_line": ("n_words", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_a_word": ("n_marks", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
}
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_MARK = np.isin(np.arange(256), [ord(c) for c in "!?"])
_CODE = np.arange(256)
_UPPER, _DIGIT = (_CODE >= 65) & (_CODE <= 90), (_CODE >= 48) & (_CODE <= 57)
_CHAR = (_CODE & 0xC0) != 0x80


def count(texts: pa.Array) -> dict[str, np.ndarray]:
    """The COUNTS of each text."""
    w = W.split(texts)
    n = len(w.first) - 1
    here = w.text_of_word().astype(np.uint64)
    own = W.mix(here + W.U64(1))
    at, keys = W.windows(w.hashes, w.first, 3)
    again = at[W.in_several(keys ^ own[at])]
    repeated = W.covered(len(w.hashes), again, 3)
    distinct = ~W.seen_before(w.hashes ^ own)
    inside = W.SPACED[w.data] & _CHAR[w.data]
    # Lines: from a text's start or after a line break, to the next one or the end.
    breaks = np.flatnonzero(w.data == 10)
    starts, ends = np.concatenate([w.offsets[:-1], breaks + 1]), np.concatenate([breaks, w.offsets[1:]])
    starts.sort()
    ends.sort()
    of = np.repeat(np.arange(n), w.per_text(w.data == 10) + 1)
    worded = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, of = starts[worded], ends[worded], of[worded]
    lines = W.byte_hash(w.data, starts, ends) ^ W.mix(of.astype(np.uint64) + W.U64(1))
    return {
        "n_words": w.counts,
        "word_chars": w.per_text(inside),
        "n_symbols": w.per_text(_SYMBOL[w.data]),
        "n_dup_lines": np.bincount(of[W.seen_before(lines)], minlength=n),
        "n_repeat_words": w.words_with(repeated),
        "n_lines": np.bincount(of, minlength=n),
        "n_upper": w.per_text(_UPPER[w.data]),
        "n_digits": w.per_text(_DIGIT[w.data]),
        "n_marks": w.per_text(_MARK[w.data]),
        "n_distinct": w.words_with(distinct),
    }


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in W.chunks(batches):
        found = count(piece["text"])
        yield pa.RecordBatch.from_arrays([piece["doc_id"], *[pa.array(found[c], pa.int64()) for c in COUNTS]], ["doc_id", *COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the COUNTS, base_failed."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return text_rows(docs).mapInArrow(_count_batches, schema).withColumn("base_failed", failed)


def feature(name: str) -> Column:
    above, below = FEATURES[name]
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.limit if self.above else x[self.feature] <= self.limit

    def column(self) -> Column:
        return feature(self.feature) > self.limit if self.above else feature(self.feature) <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"


Rule = tuple[Condition, ...]


def _fits(rule: Sequence[Condition], x: dict[str, np.ndarray], size: int) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(x) for c in rule), np.ones(size, bool))


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int, steps: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, gain = None, 1e-9
        for name, values in x.items():
            here = np.unique(values[inside])
            if len(here) > steps:
                here = np.unique(np.quantile(here, np.linspace(0, 1, steps)))
            order = np.argsort(values[inside], kind="stable")
            sorted_values, sorted_bad = values[inside][order], bad[inside][order]
            limits = (here[1:] + here[:-1]) / 2
            upto = np.searchsorted(sorted_values, limits, side="right")
            bad_upto = np.concatenate([[0], np.cumsum(sorted_bad)])[upto]
            for above in (False, True):
                p = p0 - bad_upto if above else bad_upto
                n = (len(sorted_bad) - upto if above else upto) - p
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0)
                if len(gains) and gains.max() > gain:
                    gain, best = gains.max(), Condition(name, above, float(limits[gains.argmax()]))
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, prune: np.ndarray, precision: float = 0.95,
          least: int = 3, most_conditions: int = 4, most_rules: int = 24, steps: int = 64) -> list[Rule]:
    """Ordered rules that tell bad rows; ``prune`` marks the rows kept back for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules and (left & bad & ~prune).sum() >= least:
        grow = left & ~prune
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], most_conditions, steps)
        check = left & prune
        checked = {k: v[check] for k, v in x.items()}

        def worth(r: Rule) -> float:
            fits = _fits(r, checked, int(check.sum()))
            p, n = (fits & bad[check]).sum(), (fits & ~bad[check]).sum()
            return (p - n) / max(p + n, 1)

        if not rule:
            break
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        fits = _fits(rule, x, len(bad)) & left
        p, n = (fits & bad).sum(), (fits & ~bad).sum()
        q = fits & prune
        if p < least or p < precision * (p + n) or (q & bad).sum() < precision * q.sum():
            break
        rules.append(rule)
        left &= ~fits
    return rules


def rule_column(rules: Sequence[Rule]) -> Column:
    """The text of the first rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        fits = reduce(lambda a, b: a & b, (c.column() for c in rule))
        out = F.when(fits, F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def fit(stats: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> list[Rule]:
    """Learn from at most ``most_rows`` labelled rows (by a hash of the id) that pass the base rules."""
    known = labels.select(F.col("doc_id").alias("known"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)")
    rows = stats.filter(~F.col("base_failed")).join(known, F.col("doc_id") == F.col("known"))
    order = F.xxhash64(F.lit(11), "doc_id")
    # Equal rows teach once, so that hashes below a limit are as many as the limit says.
    rows = settle(rows.select(*[feature(f).alias(f) for f in FEATURES], "quality", order.alias("order")).distinct(), "quality-sample")
    n = rows.count()
    if n > most_rows:  # some more than wanted pass this limit; only they are ordered
        rows = rows.filter(F.col("order") < int(-(1 << 63) + (1 << 64) * min(0.999, 1.1 * most_rows / n + 1e-6)))
    sample = rows.orderBy("order", *FEATURES, "quality").limit(most_rows).toPandas()
    bad = (sample["quality"] == 0).to_numpy()
    if not bad.any() or bad.all():
        return []
    prune = (sample["order"].to_numpy().astype(np.int64) % 3) == 0
    return learn({f: sample[f].to_numpy(float) for f in FEATURES}, bad, prune)


def judge(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """doc_id, the COUNTS, base_failed, rule and kept for each document."""
    stats = settle(statistics(docs), "quality-statistics")
    rule = rule_column(fit(stats, labels, most_rows))
    out = stats.withColumn("rule", F.when(~F.col("base_failed"), rule))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, all their columns.

    The rules are learned from the labelled documents' statistics and applied
    to each row in the same pass over the text: no join brings verdicts back.
    """
    known = labels.select(F.col("doc_id").alias("known"), "quality").filter("quality in (0, 1)")
    marked = text_rows(docs).join(known.select("known").distinct(), F.col("doc_id") == F.col("known"), "left_semi")
    rules = fit(settle(statistics(marked), "quality-labelled"), labels)
    rule = rule_column(rules)
    return statistics_beside(docs).filter(~F.col("base_failed") & rule.isNull()).select("doc.*")


def statistics_beside(docs: DataFrame) -> DataFrame:
    """The documents, each row whole in a column ``doc`` so that no name clashes, with the COUNTS and base_failed."""
    rows = importable(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").cast("string").alias("text"))
    schema = rows.select("doc", *[F.lit(0).cast("long").alias(c) for c in COUNTS]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.chunks(batches):
            found = count(piece["text"])
            yield pa.RecordBatch.from_arrays([piece["doc"], *[pa.array(found[c], pa.int64()) for c in COUNTS]], ["doc", *COUNTS])

    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.mapInArrow(run, schema).withColumn("base_failed", failed)
