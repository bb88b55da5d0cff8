"""Labelled rows for training: the held-out fold and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most `rows` labelled ids outside the held-out fold, in the order of a hash of the id.

    The sample of ids is small by its limit, so it may be broadcast; documents are not shuffled. docs has (doc_id, text).
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    chosen = usable.select("doc_id", F.col(label).cast("double").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    return docs.join(F.broadcast(chosen), "doc_id")
