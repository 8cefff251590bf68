"""Joins of facts with place tables.

No join here carries a broadcast hint: a place table has as many rows as the data has places.
Spark broadcasts it when its measured size is under the session's threshold, and otherwise
sorts and merges. Keys that hold very many rows are counted, and their rows are dealt over several tasks (:func:`salted_join`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.session import broadcast_if_small, materialize

#: A key with more rows than this is split.
HOT_ROWS = 1 << 20
NULL_SALTS = 4096

PLACE = ["departamento", "municipio"]


def salted_join(
    many: DataFrame, few: DataFrame, on: list[str], how: str = "inner", hot_rows: int = HOT_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """``many.join(few, on, how)``, an inner or left join, without a task that gets all rows of a hot key.

    Rows of ``many`` are counted by key, inside the map tasks first. A key of more than ``hot_rows`` is dealt over as
    many parts as it takes, and only its rows of ``few`` are repeated, once for each part. A row whose key has a
    null finds nothing and is dealt by all its columns. ``counted`` may be a smaller table with the same keys to count in.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"{how} joins are not split")
    none = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    sizes = (many if counted is None else counted).groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    hot = materialize(sizes.select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")), "hot-keys")
    if hot.isEmpty():
        return many.join(few, on, how)
    hot = broadcast_if_small(hot.where(~none))
    spread = F.xxhash64(*[c for c in many.columns])
    parts = F.when(none, NULL_SALTS).otherwise(F.coalesce("_salts", F.lit(1)))
    dealt = many.join(hot, on, "left").withColumn("_salt", F.pmod(spread, parts).cast("int")).drop("_salts")
    repeated = few.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")


def left_join_dims(fact: DataFrame, dims: list[DataFrame], on: list[str] = PLACE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join each dimension on the place."""
    for dim in dims:
        fact = salted_join(fact, dim, on, "left", hot_rows)
    return fact


def neighbor_or_self(places: DataFrame, mapping: DataFrame, prefix: str) -> DataFrame:
    """For each place, the reference place to read from: its neighbour, else its own name.

    Output: the place plus ``<prefix>_dept`` and ``<prefix>_muni``.
    """
    dept, muni = f"{prefix}_dept", f"{prefix}_muni"
    found = mapping.select(
        F.col("target_dept").alias("departamento"), F.col("target_muni").alias("municipio"),
        F.col("ref_dept").alias(dept), F.col("ref_muni").alias(muni),
    )
    return places.select(*PLACE).distinct().join(found, PLACE, "left").select(
        *PLACE,
        F.coalesce(dept, "departamento").alias(dept),
        F.coalesce(muni, "municipio").alias(muni),
    )


def impute_from_neighbor(
    fact: DataFrame, mapping: DataFrame, measures: DataFrame, grain: list[str],
    places: DataFrame | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join the measures of each place's neighbour (or of the place itself).

    ``measures`` holds the place, the ``grain`` columns (week, or year) and its values. The
    neighbour is resolved once per place and the measures are re-labelled with the places that
    read them, so the fact is joined once and not once per step. ``places`` are the fact's
    places where the caller has them at hand. A place and week (or year) that very many facts share is split over several tasks.
    """
    values = [c for c in measures.columns if c not in PLACE + grain]
    source = measures.withColumnsRenamed({"departamento": "ref_dept", "municipio": "ref_muni"})
    served = (
        neighbor_or_self(fact if places is None else places, mapping, "ref")
        .join(source, ["ref_dept", "ref_muni"])
        .select(*PLACE, *grain, *values)
    )
    return salted_join(fact, served, PLACE + grain, "left", hot_rows)
