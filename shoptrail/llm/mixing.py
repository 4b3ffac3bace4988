"""Mixing sources to target weights.

Tokens are summed per source; a source's repetition rate is its target over
its size. A document is emitted floor(rate) times, and once more with the
probability that is left, drawn from a hash of a seed and its id, so that
every run draws alike.

Defined cases: a null text has size 0. A null source is a source of its own,
after all others. Equal ids share a draw. Documents of a source without words
are emitted once. An empty table gives an empty one. A plan replaces columns
that clash with the ones it adds; a mixture keeps all columns but one named
copy, which becomes the number of the copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.tables import same, settle

WORD = r"[^\x20\x09-\x0D]+"
ADDED = ("size", "source_size", "target", "copies", "taken", "copy")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the seed and the key alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Targets per source from (source, source_size): ``share`` of all words, divided by weight.

    No target is above ``most`` times its source; what is cut off goes to the
    others by weight. Sources take the weights in turn by code point. A source
    is full just if filling all sources up to its own ratio of cap to weight
    stays within the budget: one window over sources finds them. It runs in one
    task, over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    whole = Window.partitionBy()
    upto = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    out = sizes.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    out = out.withColumn("cap", F.col("source_size") * most)
    out = out.withColumns({
        "caps": F.sum("cap").over(upto).cast("double"),
        "weighed": F.sum("weight").over(upto),
        "all_weight": F.sum("weight").over(whole),
        "budget": F.sum("source_size").over(whole) * F.lit(share),
    })
    full = F.col("caps") * F.col("weight") + F.col("cap") * (F.col("all_weight") - F.col("weighed")) <= F.col("budget") * F.col("weight")
    out = out.withColumn("full", full)
    out = out.withColumns({
        "used": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole).cast("double"),
        "open_weight": F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col("weight"))).over(whole),
    })
    part = (F.col("budget") - F.col("used")) * F.col("weight") / F.col("open_weight")
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), part))
    return out.select("source", "source_size", target.alias("target"))


def plan_copies(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """All documents with size, source_size, target, copies and taken."""
    sized = docs.drop(*ADDED).withColumn("size", word_count(F.col("text")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = settle(targets(sizes, weights, share, most).withColumnRenamed("source", "goal_source"), "mix-targets")
    joined = sized.join(goal, same(sized["source"], goal["goal_source"])).drop("goal_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    whole = F.floor(rate)
    copies = whole + (draw(F.col("doc_id"), seed) < rate - whole).cast("long")
    return joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """The mixture: each document's row as often as planned, all its columns as they came, with the number of the copy."""
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text", "source")
    planned = plan_copies(slim, weights, share, most, seed).filter(F.col("copies") > 0)
    rows = planned.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c.lower() != "copy"], "copy")
