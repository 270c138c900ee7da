"""A corpus from documents to token files: quality, near-duplicates, benchmark leaks, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. The mix is an order: its files hold the documents in the order of
the schedule, and the last stage writes the token ids in the order of the files it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import decontam, mixing, quality, simhash, tokens
from lamina.llm.common import stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject; it learns from the labelled ones among them."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, those with a Jaccard similarity of 0.8 or more (5-word shingles) included."""
    return simhash.keep_one(docs, size=5, radius=4)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their sources interleaved to weights by the square root of their sizes."""
    return mixing.in_mixed_order(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read back from token files in the order of the mix."""
    return tokens.digest(docs, in_file_order=True)


STAGES = [
    ("quality_classifier", good_documents), ("simhash_near_dedup", one_of_each), ("benchmark_decontamination", without_leaks),
    ("mixing", mixed), ("token_output", as_tokens),
]

# Compression, fingerprints and latent vectors are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
