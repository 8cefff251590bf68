"""Connected components of links between ids, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); the component is its smallest id.

    A large step links the neighbours above an id to the smallest of its neighbourhood, a small step
    those below it. Both keep components as they are and end in stars, after a number of rounds that
    grows with the logarithm of the size. Minima are taken per task before anything is shuffled.
    Each round is a stored table, so a lost executor repeats one round at most.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        step = rest.unionByName(below.withColumnRenamed("m", "b"))
        turned = step.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = materialize(turned.where("a <> b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
