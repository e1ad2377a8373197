"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage works on all rows that its predecessor kept.  Rows with null or
empty text and repeated rows are treated as the operators state; extra columns
go through untouched.  The last stage returns the mix: how many words it takes
of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caselabel.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing
from caselabel.llm.samples import fold_of
from caselabel.llm.tables import table, written

#: Least score of the nearest language.  What is in no known language has no score; ``language_id.LOST`` settles that.
LEAST_LANGUAGE_SCORE = 0.2


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those in none of the languages learned from the other two thirds of the labels."""
    model = language_id.fit(docs.where(fold_of(docs["doc_id"], 3) != 1))
    return language_id.keep_known(docs, model, LEAST_LANGUAGE_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines found in three or more documents, but for the one in the largest ``doc_id``; no document goes."""
    return line_dedup.dedup_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest ``doc_id`` of each group of texts whose sets of five-word shingles are 0.8 similar, by links."""
    return jaccard_join.keep_first(docs, k=5, num=80, den=100)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold half of a benchmark item or more."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document left."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontaminate", drop_benchmark_copies),
    ("mix", mix_sources),
]

#: Language prediction and greedy tiling have no SQL form; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
