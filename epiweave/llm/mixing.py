"""Mixing sources to target weights by fitting word budgets with subset sums.

Documents are counted by exact length. Most of a source's budget goes to its lengths in
proportion; a bounded-knapsack program over the lengths left fits the rest, exactly where some subset of
documents can. Which documents of a length are taken follows a seeded hash, so reruns agree.

Defined results: a null or blank text has size 0 and is never needed; null is a source of its own,
last in order; a source without words gets the target 0; repeated rows are documents of their own;
an empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiweave.session import materialize

WORD = "[^\\x20\\x09-\\x0D]"
GAP = "[\\x20\\x09-\\x0D]"
#: Words of a source's budget that are left to the knapsack program.
KNAPSACK_WORDS = 1 << 16
#: Parts of a group of equal length; ranks are taken in one part only.
RANK_PARTS = 4096


def word_count(text: Column) -> Column:
    """Number of words, without an array of them: each word and the space around it becomes one letter."""
    marks = F.regexp_replace(text, F.lit(f"{GAP}*+{WORD}++{GAP}*+"), F.lit("x"))
    return F.when(text.rlike(WORD), F.length(marks)).otherwise(0).cast("long")


def fit(lengths: list[int], counts: list[int], budget: int, window: int = KNAPSACK_WORDS) -> list[int]:
    """How many documents of each length (all above 0) sum up nearest to ``budget`` words.

    All but about ``window`` words are dealt out to the lengths in proportion, longest first, where
    what a length can't use goes to the shorter ones. The rest is a bounded knapsack: a bit set of
    reachable sums, to which each length adds its documents in powers of two. For every sum that
    becomes reachable the item that reached it first is kept, which is enough to walk back.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    total = sum(n * c for n, c in zip(lengths, counts))
    budget = max(0, min(budget, total))
    aim, taken, seen = budget - window, 0, 0
    chosen = [0] * len(lengths)
    if aim > 0:
        for i in order:
            seen += lengths[i] * counts[i]
            chosen[i] = max(0, min(counts[i], (aim * seen // total - taken) // lengths[i]))
            taken += chosen[i] * lengths[i]
    rest = budget - taken
    top = rest + max(lengths, default=0)
    full, reached, by, items = (1 << (top + 1)) - 1, 1, np.full(8 * (top // 8 + 1), -1), []
    for i in order:
        left, size = counts[i] - chosen[i], 1
        while left and not reached >> rest & 1:
            size = min(size, left)
            new = (reached << lengths[i] * size) & full & ~reached if lengths[i] * size <= top else 0
            if new:
                reached |= new
                bits = np.frombuffer(new.to_bytes(top // 8 + 1, "little"), np.uint8)
                by[np.flatnonzero(np.unpackbits(bits, bitorder="little"))] = len(items)
            items.append((i, size))
            left, size = left - size, size * 2
    sums = np.concatenate([[0], np.flatnonzero(by >= 0)])
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at:
        i, size = items[by[at]]
        chosen[i] += size
        at -= lengths[i] * size
    return chosen


def targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """Adds ``target`` to (source, source_size): ``share`` (a fraction) of all words by weight, where
    no source gets more than ``most`` times its size and what it can't take goes to the others.

    Weights repeat over the sources in code point order, null last. Ranks come from a range sort
    with counts per partition, and each round of resharing collects one row of sums, so that
    the number of sources is not limited.
    """
    spark = sources.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = materialize(
        sources.withColumn("_none", F.col("source").isNull())
        .repartitionByRange(n, "_none", "source").withColumn("_part", F.spark_partition_id()), "mix-sources",
    )
    parts = ordered.groupBy("_part").count()
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy("_none", "source")) - 1
    weight = F.element_at(F.lit(list(weights)), (rank % len(weights) + 1).cast("int")).cast("long")
    weighed = materialize(
        ordered.join(parts, "_part").withColumn("weight", weight).select("source", "source_size", "weight"), "mix-weights"
    )
    above, fixed_words, fixed_weight = F.lit(False), -1, 0
    totals = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    words, weight_sum = totals[0] or 0, totals[1] or 0
    while True:
        # words per weight = up / down, compared in whole numbers so that no rounding decides
        capped = weighed.where(above).agg(F.sum("source_size"), F.sum("weight")).first()
        now, fixed_weight = capped[0] or 0, capped[1] or 0
        up, down = share[0] * words - share[1] * most * now, share[1] * (weight_sum - fixed_weight)
        if now == fixed_words or down <= 0 or up < 0:
            break
        fixed_words = now
        per_weight = up / down
        above = F.col("source_size") * most * F.lit(down).cast("decimal(38,0)") < F.col("weight") * F.lit(up).cast("decimal(38,0)")
    level = F.lit(float(per_weight)) * F.col("weight") if words else F.lit(0.0)
    return weighed.withColumn("target", F.least(level, (F.col("source_size") * most).cast("double")))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2, seed: int = 17,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, repeats, taken) of every row of ``docs``.

    ``repeats`` is how often the mix takes the document, at most ``most`` times.
    """
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    sized = materialize(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .withColumn("_key", key).withColumn("_part", F.shiftrightunsigned("_key", 52).cast("int")), "mix-sizes",
    )
    histogram = sized.groupBy("source", "size").count()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = materialize(targets(sources, weights, share, most), "mix-targets")

    def per_source(rows: pd.DataFrame) -> pd.DataFrame:
        size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        base = min(most, int(target // size)) if size else 0
        rows = rows[["source", "size", "count"]].assign(base=base, extra=0)
        if size and base < most:
            some = rows["size"] > 0
            rows.loc[some, "extra"] = fit(rows.loc[some, "size"].tolist(), rows.loc[some, "count"].tolist(), round(target - base * size))
        return rows[["source", "size", "base", "extra"]]

    same = F.col("h.source").eqNullSafe(F.col("g.source"))
    planned = materialize(
        histogram.alias("h").join(goals.alias("g"), same)
        .select("h.source", "h.size", "h.count", "g.source_size", "g.target")
        .groupBy("source").applyInPandas(per_source, "source string, size long, base int, extra long"), "mix-plan",
    )
    # rank only where some but not all documents of a length are taken, and only inside one part of it
    parts = sized.groupBy("source", "size", "_part").count()
    earlier = Window.partitionBy("source", "size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("count").over(earlier), F.lit(0))
    share_of = planned.alias("p").join(
        parts.select("source", "size", "_part", "count", before.alias("before")).alias("q"),
        F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("p.size") == F.col("q.size")),
    ).select("q.source", "q.size", "q._part", "base", (F.col("extra") - F.col("before")).alias("room"))
    within = Window.partitionBy("s.source", "s.size", "s._part").orderBy("s._key", "s.doc_id")
    picked = (
        sized.alias("s").join(
            share_of.alias("r"),
            F.col("s.source").eqNullSafe(F.col("r.source")) & (F.col("s.size") == F.col("r.size")) & (F.col("s._part") == F.col("r._part")),
        )
        .withColumn("repeats", F.col("base") + (F.row_number().over(within) <= F.col("room")).cast("int"))
        .select("s.doc_id", "s.source", "s.size", "repeats")
    )
    return (
        picked.alias("d").join(goals.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
        .select("d.doc_id", "d.source", "d.size", "g.source_size", "g.target", "d.repeats", (F.col("d.repeats") * F.col("d.size")).alias("taken"))
    )
