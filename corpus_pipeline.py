"""The corpus pipeline: five of the corpus operators in a row over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.llm import cotrain, mix, pack, secrets, simhash
from starflow.llm.common import read, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return cotrain.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.deduplicate(docs)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts masked."""
    return secrets.mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources draws them."""
    return mix.draw(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in their sequences, with their ids."""
    return pack.pack(docs, with_ids=True).drop("piece")


STAGES = [
    ("quality_classifier", quality),
    ("simhash_dedup", near_duplicates),
    ("secret_scan", secret_masking),
    ("mix_sources", mixing),
    ("pack_sequences", packing),
]

#: Trained models and packing have no SQL form; tests/llm checks each stage on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
