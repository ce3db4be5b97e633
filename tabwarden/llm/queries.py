"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.llm import (
    conversation, decontaminate, exact_dedup, filter_audit, html, language, licenses, mixing, near_dup, packing, quality, repeats, secrets,
)
from tabwarden.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", F.round("host_rate", 6).alias("host_rate"), F.coalesce("host_condemned", F.lit(False)).alias("host_condemned"),
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.array_join("notices", ","))


def op6_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chunks")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.repair(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality_rules": op3_quality_rules,
    "op4_mix_sources": op4_mix_sources,
    "op5_license_scan": op5_license_scan,
    "op6_pack_tokens": op6_pack_tokens,
    "op7_remove_repeats": op7_remove_repeats,
    "op8_language": op8_language,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_page_text": op10_page_text,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_conversation_repair": op13_conversation_repair,
}
