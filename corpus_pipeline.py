"""Corpus pipeline: quality, near duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each stage's result to the cluster's shared folder and
reads it back as the next one's documents, so a lost executor costs at most one
stage's tasks.  All stages but the last return the columns of ``documents``.

Rows that a stage keeps stay whole, with all their columns, also ones whose names the
operators use inside; the last stage returns pieces.  Null texts count as empty: they are
scored, are no one's copies, hold no leak and no personal data, and pack as one end token.
Null ids take part like others: they are judged by their text, and of copies the one with
the least id stays, null being the largest.  Repeated rows are judged alike; the
near-duplicate stage keeps one of them.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import best_fit_packing, decontaminate, ngram_join, pii, pu_quality
from pulseframe.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier rejects go."""
    return pu_quality.reject(docs, pu_quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each n-gram Jaccard class stays."""
    return ngram_join.deduplicate(spark, docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is masked; every document stays."""
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all remaining documents with their sequence and place."""
    return best_fit_packing.pack(spark, docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("leaks", leaks),
          ("personal_data", personal_data), ("packing", packing)]

#: Classifier, near-duplicate classes and tokens are beyond SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
