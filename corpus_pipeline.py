"""Corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. :func:`run` writes
every stage as Parquet to the shared folder and reads it again, so a stage never
replays the ones before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, exact_dedup, minhash, packing, toxicity
from ledgerline.llm.common import documents, saved, table


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field does not find toxic; fitted on labelled rows outside the held-out fold."""
    return toxicity.accept(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.deduplicate(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth of their words in benchmark windows."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", keep_clean), ("exact_dedup", exact), ("minhash", near), ("decontamination", uncontaminated),
          ("best_fit_packing", packed)]

# Training a field, near-duplicate components and tokens are beyond SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
