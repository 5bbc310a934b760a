"""The corpus pipeline: toxicity, quality, exact dedup, near dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads; all but the last return
the columns of ``documents``.  ``run`` writes each stage as Parquet in the shared folder and rereads
it, so a lost executor never reaches further back than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import exact_dedup as dedup
from paddock.llm import jaccard_join, quality, toxicity
from paddock.llm.common import materialise, table
from paddock.llm.queries import pack_digests, quality_model, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more for toxicity go."""
    return toxicity.select_clean(docs, toxicity_model(spark, docs, sf_dir))


def drop_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely junk than not go."""
    return quality.select_quality(docs, quality_model(spark, docs, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text stays (the largest id)."""
    index = dedup.DigestIndex(spark)
    dedup.index_batch(docs, index)
    return dedup.unique_rows(docs, index)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.one_per_component(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, packed into sequences of at most 1024 tokens."""
    return pack_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", drop_junk),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("best_fit_packing", packing),
]

ORACLE_SQL = None  # learned scores and tokenizers have no SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
