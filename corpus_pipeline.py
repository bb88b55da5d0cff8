"""A training corpus in five stages; each stage's rows are written as Parquet and read again by the next.

Every stage works on all that its predecessor kept. All but the last return the columns of documents, whatever further
columns these have.

Defined results: a null text counts as empty; it is scored like any text, is an exact copy of other texts without words,
links with nothing, leaks nothing and is packed as one piece that holds the end id; rows with a null id pass through the
stages like others, losing ties to rows that have one; repeated rows are exact copies, of which one stays; an empty table
gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontamination, exact_dedup, ngram_join, packing, quality
from tickloom.llm.common import staged


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of exact copies one stays."""
    return exact_dedup.kept_rows(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of their 5-word shingles one stays."""
    return ngram_join.keep_one_of_each(docs, n=5, percent=80)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in windows of 4096."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", distinct_documents),
    ("ngram_jaccard_join", unlike_documents),
    ("benchmark_decontamination", clean_documents),
    ("packing", packed_documents),
]
#: SQL cannot train a classifier or tile strings; tests/llm hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
