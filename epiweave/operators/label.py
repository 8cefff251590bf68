"""Outbreak label against a historic percentile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.fixed import OUTBREAK_NO, OUTBREAK_PERCENTILE, OUTBREAK_YES


def outbreak_threshold(
    base: DataFrame, keys: list[str], value: str = "casos_totales",
    percentile: float = OUTBREAK_PERCENTILE,
) -> DataFrame:
    """Percentile of the value per group. The sketch merges partial results of map tasks, so a
    group of any size needs no single task that sees its rows."""
    return base.groupBy(*keys).agg(F.percentile_approx(value, percentile).alias("umbral"))


def outbreak_label(
    df: DataFrame,
    base: DataFrame | None = None,
    keys: tuple[str, ...] = ("enfermedad", "municipio"),
    value: str = "casos_totales",
    percentile: float = OUTBREAK_PERCENTILE,
) -> DataFrame:
    """Add ``brote``: SI when the value is strictly above its group's percentile over ``base``
    (default: ``df`` itself). A missing value or threshold counts as 0."""
    thresholds = outbreak_threshold(df if base is None else base, list(keys), value, percentile)
    joined = df.join(thresholds, list(keys), "left").fillna(0, [value, "umbral"])
    above = F.col(value) > F.col("umbral")
    return joined.withColumn("brote", F.when(above, OUTBREAK_YES).otherwise(OUTBREAK_NO)).select(
        *df.columns, "brote"
    )
