"""Registered queries of the document operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    embedding_dedup,
    filter_audit,
    licenses,
    line_dedup,
    mixing,
    packing,
    pii,
    quality_rules,
    simhash,
    spelling,
    syncmers,
    toxicity,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, how many were dropped and which, and a digest of the text that stays."""
    clean = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return clean.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"),
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("clean_sha256"),
    )


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema)
    return chat.read_back(chat.format_conversations(rows.union(extra)))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_simhash_near_dedup": op1_simhash_near_dedup,
        "op2_line_dedup": op2_line_dedup,
        "op3_pii_spans": op3_pii_spans,
        "op4_toxicity": op4_toxicity,
        "op5_chat_formatting": op5_chat_formatting,
        "op6_packing": op6_packing,
        "op7_source_mixing": op7_source_mixing,
        "op8_quality_rules": op8_quality_rules,
        "op9_license_scan": op9_license_scan,
        "op10_syncmer_fingerprints": op10_syncmer_fingerprints,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_embedding_near_dedup": op12_embedding_near_dedup,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_quality_rules": quality_rules.ORACLE,
        "op9_license_scan": licenses.ORACLE,
        "op13_filter_audit": filter_audit.ORACLE,
    }
