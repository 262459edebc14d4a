"""The operators bound to the tables of a folder, one query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import audit, chat, containment, jaccard, langid, packing, passages, quality, repeats, resharding, secrets, warc, whitening
from shoplens.llm.common import documents


def op1_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality(documents(spark, sf_dir), quality.trusted_ids(labels))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf_dir))


def op3_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_join(documents(spark, sf_dir)).drop("text_key")


def op4_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_min_cost_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.reshard_documents(documents(spark, sf_dir))


def op6_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.duplicate_passages(documents(spark, sf_dir))


def op8_unigram_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op9_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return views.withColumn("mask_spans", chat.mask_text(F.col("masks"))).drop("masks")


def op10_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.cut_repeats(documents(spark, sf_dir))
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_quality": op1_ngram_quality,
    "op2_secret_scan": op2_secret_scan,
    "op3_chosen_path_join": op3_chosen_path_join,
    "op4_warc_normaliser": op4_warc_normaliser,
    "op5_min_cost_reshard": op5_min_cost_reshard,
    "op6_benchmark_containment": op6_benchmark_containment,
    "op7_compact_windows": op7_compact_windows,
    "op8_unigram_language": op8_unigram_language,
    "op9_perspective_rotation": op9_perspective_rotation,
    "op10_concatenate_and_cut": op10_concatenate_and_cut,
    "op11_filter_audit": op11_filter_audit,
    "op12_cholesky_whitening": op12_cholesky_whitening,
    "op13_suffix_repeats": op13_suffix_repeats,
}

ORACLES: dict[str, str] = {"op9_perspective_rotation": chat.ORACLE_SQL, "op11_filter_audit": audit.ORACLE_SQL}
