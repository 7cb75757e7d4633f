"""A corpus from raw documents to packed sequences, stage by stage.

Each stage gets the documents that its predecessor kept, written as Parquet and read again, and
all stages but the last return documents of the same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import compression, exact, mixing, packing, simhash
from strata.llm.common import documents, prepared, table
from strata.scratch import materialise

END_ID = 0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    return compression.accepted(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact copies."""
    return exact.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepared(spark)
    return simhash.near_dedup(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources uses them."""
    return mixing.mixed(docs)


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    prepared(spark)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(docs, tokenizer, end_id=END_ID).drop("ids")


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("simhash near-dedup", near_copies),
    ("mixing to target weights", mixture),
    ("best-fit packing", packs),
]

# Compression, fingerprints and tokenizers are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, "pipeline-stage")
    return docs
