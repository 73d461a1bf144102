"""What the two classifiers share: the held-out rule and a bounded sample of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out() -> Column:
    """True where crc32 of the doc_id as text leaves no rest by 5; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most `rows` labelled documents outside the held-out fold.

    They are the labelled ids with the smallest hashes, so the choice depends on ids alone. A doc_id with several labels
    counts once, with the largest label, and so does one with several rows, with the text of the smallest hash: no more rows than ids
    come out. Only ids and labels are ordered; texts are read by a join with the chosen ids, whose number the bound proves small.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Texts travel once, behind the one that their id keeps; equal hashes are equal texts here.
    kept = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("kept"))
    return kept.select("doc_id", "kept.text", "label")
