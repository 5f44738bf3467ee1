"""A bounded sample of labelled documents, chosen by the hash of the id alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """(text, label) of at most ``most`` labelled rows outside the held-out fold.

    The labels are cut to the bound before they meet the documents, so what is sent to the tasks
    is bounded too. A document with several labels is left out, as are null labels.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
    known = known.where((F.col("label") == F.col("other")) & (remainder(folds) != held_out)).select("doc_id", "label")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
