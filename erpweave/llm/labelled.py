"""Labelled rows for fitting: a bounded, seeded sample that leaves out every fifth document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text is divisible by 5; a null doc_id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def class_counts(labels: DataFrame, label: str) -> tuple[int, int]:
    """Rows with label 0 and 1 that may be learned from."""
    row = (
        labels.filter(~held_out(F.col("doc_id")))
        .agg(F.count_if(F.col(label) == 0).alias("none"), F.count_if(F.col(label) == 1).alias("some"))
        .first()
    )
    return int(row.none), int(row.some)


def fit_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_bytes: int
) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` rows of each class, in a seeded order.

    Only labelled rows outside the held-out fifth and, to bound the driver's memory, texts of
    at most ``max_bytes`` bytes are fitted on. The result is at most 2 * per_class * max_bytes.
    """
    known = labels.filter(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1)).select(
        F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")
    )
    order = F.xxhash64("_id")
    # Twice as many ids as rows wanted, as too long texts fall out after the join.
    ids = known.filter("_label = 0").orderBy(order, "_id").limit(2 * per_class).unionByName(
        known.filter("_label = 1").orderBy(order, "_id").limit(2 * per_class)
    )
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text")).filter(
        F.octet_length("_text") <= max_bytes
    )
    found = texts.join(F.broadcast(ids), "_id")  # at most 4 * per_class rows
    rows = found.filter("_label = 0").orderBy(order, "_id", "_text").limit(per_class).unionByName(
        found.filter("_label = 1").orderBy(order, "_id", "_text").limit(per_class)
    )
    return sorted(((r["_text"], r["_label"]) for r in rows.select("_text", "_label").collect()))
