"""From raw documents to a training mixture: the stages, in order.

Each stage works on all that the one before it kept, is written as Parquet and
read again. All but the last return the columns of ``documents``; the last
adds the number of the copy.

Defined cases: a null or empty text, or one of under 50 words, fails the first
stage's base rules and goes. Documents without id pass the line and near-copy
stages as they are. Of near copies the smallest id stays; rows that share an id
are one document and must repeat its text. Very long texts are read whole. Extra
columns pass all stages as they are, whatever their names, but for n_lines,
n_dropped and n_words_dropped, which line dedup uses, and copy, which the last
stage sets. Empty tables give an empty mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm import decontaminate, lines, mixing, neardup, quality
from shoptrail.llm.queries import table
from shoptrail.llm.tables import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; the count of characters follows the text."""
    done = lines.drop_lines(docs)
    counted = done.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return counted.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's row as often as its source's rate asks for, with the copy's number."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]
# The learned rules have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of a folder's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
