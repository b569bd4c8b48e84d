"""Corpus preparation: the stages in order, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldfit.llm import blob_ledger, block_naming, language, packing, simhash
from fieldfit.llm.common import free_name, stored
from fieldfit.session import tune

# A document in which no language holds this share of the words is rejected.
LEAST_SCORE = 0.4

# The stages cannot be written in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a prevailing language go."""
    pred, score = free_name(docs, "lang_pred", "lang_score")
    labelled = language.predict(docs, language.train(docs), pred=pred, score=score)
    return labelled.where((F.col(pred) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return block_naming.kept_rows(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest doc_id stays."""
    return simhash.kept_rows(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    return blob_ledger.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
