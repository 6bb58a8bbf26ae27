"""The corpus pipeline: documents in, padded batches of clean documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, jaccard_join, packing, pii, quality
from tessera.llm.common import written
from tessera.llm.queries import table, tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def length_packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are placed in batches of near-equal length."""
    return packing.packed(docs, tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("PII", without_pii),
    ("packing", length_packed),
]

#: SQL cannot express the stages; tests hold the operators against brute force, and each stage against the rows it must keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the batch of each document that all stages keep.

    Documents without text fail the quality rules; rows with a null id pass the
    stages that report by id; rows of one id and text stay or go together; an empty table
    gives an empty table.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
