"""A training-corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.

1. language ID: documents without a letter, or without a likely language, go;
2. n-gram Jaccard join: of each class of near copies the least document stays;
3. benchmark decontamination: documents that contain a benchmark item go;
4. secret scans: secrets, encoded ones too, are replaced by marks;
5. packing: the remaining documents become windows of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import containment, jaccard, langid, packing, secrets
from shoplens.llm.common import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(langid.training_words(docs, ~langid.held_out(F.col("doc_id"))))
    return langid.keep_identified(docs, model)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return containment.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", jaccard_join),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packed),
]

#: SQL cannot express the learned language model or the tokeniser; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
