"""The corpus pipeline: documents to training mixture, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it and rereads it as the
next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardwright.llm import decontaminate, langid, mixing, ngram_join, secrets
from shardwright.llm.common import bound_batches, discard, free_names, materialise, table

#: Language ID rejects a document whose best language is less probable, or that has no letters.
LEAST_CONFIDENCE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a null lang is filled in."""
    bound_batches(spark)
    model = langid.train(langid.folds(docs).filter("not held_out"))
    found, score = free_names(docs.columns, "found", "score")
    judged = langid.identify(docs, model, docs.columns, (found, score))
    kept = judged.filter((F.col(found) != langid.UND) & (F.col(score) >= LEAST_CONFIDENCE))
    return kept.withColumn("lang", F.coalesce("lang", found)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    bound_batches(spark)
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    bound_batches(spark)
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled mixture, with each document's probability and weight."""
    bound_batches(spark)
    return mixing.mix(docs)


STAGES = [("language_id", language_id), ("ngram_join", near_duplicates), ("decontamination", decontamination), ("secret_scan", secret_scan), ("mixing", mixture)]

#: Learned models, hashed signatures and raking have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if hasattr(before, "scratch"):
            discard(before)
    return docs
