"""Labelled rows for training, and which rows may be learnt from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane import scratch


def remainder(key: str | Column, parts: int) -> Column:
    """crc32 of the key's text modulo ``parts``; a null key counts as the empty text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.crc32(text) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> DataFrame:
    """``text`` and ``y`` of at most ``per_class`` labelled documents of either class, written once.

    The rows with the smallest hashes of their ids are taken, so the choice
    depends on nothing but ids. The ids are bounded by twice ``per_class`` and
    are sent to the documents, which are not shuffled. A document labelled
    twice counts by its larger label; null labels and ids are left out.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    picked = [known.where(F.col("y") == y).orderBy("_order", "doc_id").limit(per_class) for y in (0, 1)]
    ids = picked[0].unionByName(picked[1]).select("doc_id", "y")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return scratch.durable(texts.join(F.broadcast(ids), "doc_id").select("text", "y"), "labelled")
