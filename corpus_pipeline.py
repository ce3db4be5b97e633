"""Preparing a training corpus: one stage after another over whole tables.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the ``docs`` of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwarden.llm import decontaminate, mixing, near_dup, packing, quality
from tabwarden.session import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    return quality.keep_good(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8 or more)."""
    return near_dup.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids, as they go to training."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_dup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("source mix", mix_stage),
    ("token rows", pack_stage),
]

# The stages work on shingles, edit distances and token ids, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
