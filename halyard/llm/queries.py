"""The queries of the corpus operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.llm import decontaminate, fim, hmm, jaccard, langid, licenses, media, merkle, mixing, quality, secrets, tokens, urls
from halyard.llm.shared import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_texts(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scored(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"), licenses.document_path())


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


QUERIES = {"op1_decontamination": op1_decontamination, "op2_media_columns": op2_media_columns, "op3_ngram_jaccard": op3_ngram_jaccard, "op4_quality": op4_quality, "op5_lm_scoring": op5_lm_scoring, "op6_token_counts": op6_token_counts, "op7_licenses": op7_licenses, "op8_urls": op8_urls, "op9_mixing": op9_mixing, "op10_secrets": op10_secrets, "op11_merkle": op11_merkle, "op12_fill_in_middle": op12_fill_in_middle, "op13_language_id": op13_language_id}
ORACLES = {"op3_ngram_jaccard": jaccard.OP3_SQL, "op7_licenses": licenses.OP7_SQL, "op9_mixing": mixing.OP9_SQL, "op10_secrets": secrets.OP10_SQL, "op11_merkle": merkle.OP11_SQL, "op12_fill_in_middle": fim.OP12_SQL}
