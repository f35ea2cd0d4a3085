"""A cleaning pipeline over `documents`, in stages that each call one corpus operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsharmony.llm import line_dedup, ngram_join, packing, quality_rules, substring_dedup
from obsharmony.llm.common import kept, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go."""
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats up to a word edit (two in long lines).

    A document that loses its last word is a copy and goes; missing and empty texts have lost nothing and stay."""
    left = line_dedup.dedup(docs)
    return _recounted(left.where((F.col("n_removed") == 0) | _has_word()), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that of the smallest doc_id."""
    return ngram_join.one_per_group(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; the words left are joined by a space.

    A text that loses nothing stays as it is; a document that loses its last word goes."""
    left = substring_dedup.dedup(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_words")).otherwise(F.col("text"))
    left = left.withColumn("text", text)
    return _recounted(left.where((F.col("n_removed") == 0) | _has_word()), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of at most 2048 tokens."""
    return packing.pack(docs)


def _has_word() -> Column:
    return F.col("text").rlike(r"[^\x20\x09-\x0D]")


def _recounted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs; n_chars, where there is one, follows the text."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*docs.columns)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", passages),
    ("packing", packed),
]

#: Tokens and sequences are beyond SQL; a test compares run() with a plain chain of the five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
