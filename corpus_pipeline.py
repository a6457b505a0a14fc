"""From raw documents to a training mix: quality, near duplicates, benchmark leaks, secrets, source weights.

Each stage reads what the one before wrote, keeps the columns of documents and whole rows, and its decisions
hold for all that follow. The last adds mix_copy, the number of a row's copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.llm import decontaminate, jaccard, mixing, quality, secrets
from halyard.llm.shared import table, written

#: SQL can't express the classifier.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates: five-word shingles, Jaccard of 0.8 or more."""
    return jaccard.one_of_each(docs, k=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind."""
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of each source as often as its weight asks for."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", cut_secrets),
    ("mixing sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
