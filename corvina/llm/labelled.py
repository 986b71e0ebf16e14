"""Bounded training samples of labelled documents, split by the CRC of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.pmod(F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)), F.lit(folds)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, held_out: int, per_class: tuple[int, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y) of at most ``per_class`` rows of label 0 and 1 outside the held-out fold, by order of the id's hash.

    Null ids and null labels teach nothing; of repeated labels for one id the largest counts, of rows that repeat an
    id the text with the smallest hash.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & (fold(F.col(id_col), folds) != held_out)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label).alias("y"))
    known = known.join(docs.select(F.col(id_col).alias("__i")).distinct(), F.col("__id") == F.col("__i"), "left_semi")
    order = F.xxhash64("__id"), F.col("__id")
    some = [known.where(F.col("y") == y).orderBy(*order).limit(n) for y, n in enumerate(per_class)]
    chosen = some[0].unionByName(some[1])
    return docs.select(F.col(id_col).alias("__d"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), F.col("__d") == F.col("__id")).groupBy("__id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "y")
