"""Training rows for classifiers: a bounded, seeded sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def sample_per_class(rows: DataFrame, label: str, limit: int, seed: int = 23) -> DataFrame:
    """At most ``limit`` rows of each class, those with the smallest seeded hash of doc_id."""
    order = Window.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit).drop("_rank")
