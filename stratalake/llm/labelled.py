"""A bounded sample of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out of training."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3


def held_out(doc_id: Column) -> Column:
    """Whether a row is held out; rows without an id are not."""
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` documents of each label 0 and 1 that are not held out.

    Documents are drawn in the order of a hash of their id, so the sample depends on neither partitions
    nor row order; those with more than ``max_bytes`` of text are not used for training. The drawn ids
    are at most ``2 * rows``, which bounds what is broadcast and collected. An id with several labels
    counts with the largest.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    order = F.xxhash64("doc_id")
    drawn = [usable.filter(F.col("label") == value).orderBy(order, "doc_id").limit(rows) for value in (0, 1)]
    texts = docs.select(F.col("doc_id"), F.col("text")).filter(F.octet_length("text") <= max_bytes)
    found = texts.join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id")
    return found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))
