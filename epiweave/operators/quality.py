"""Quality filters and audits. Each audit is one aggregation over one scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.fixed import SANITY_RANGES


def _in_range(name: str, low, high) -> Column:
    col = F.col(name)
    tests = [col >= low] if low is not None else []
    tests += [col <= high] if high is not None else []
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def sanity_filters(df: DataFrame, ranges: dict = SANITY_RANGES) -> DataFrame:
    """Rows whose measures all lie in their range; a null measure fails."""
    return df.where(reduce(lambda a, b: a & b, [_in_range(c, *r) for c, r in ranges.items()]))


def _long(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """One row of counts → (name, value) rows."""
    columns = one_row.columns
    return one_row.unpivot([], columns, name, value)


def sanity_rejects(df: DataFrame, ranges: dict = SANITY_RANGES) -> DataFrame:
    """Rejected rows per rule and in all: (rule, rejected)."""
    fails = {c: ~F.coalesce(_in_range(c, *r), F.lit(False)) for c, r in ranges.items()}
    fails["any_rule"] = reduce(lambda a, b: a | b, list(fails.values()))
    return _long(df.agg(*[F.count_if(t).alias(c) for c, t in fails.items()]), "rule", "rejected")


def drop_incomplete(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Rows with every required column present; by default all columns."""
    return df.dropna(subset=required)


def dedupe_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(keys) if keys else df.distinct()


def null_audit(df: DataFrame) -> DataFrame:
    """Nulls and their share per column: (column_name, nulls, pct)."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    return counts.unpivot(["_rows"], df.columns, "column_name", "nulls").select(
        "column_name",
        "nulls",
        F.when(F.col("_rows") > 0, F.round(F.col("nulls") * 100.0 / F.col("_rows"), 1))
        .otherwise(0.0).alias("pct"),
    )


def key_quality_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, nulls per key column and duplicates on the keys, where null equals null:
    (check_name, value)."""
    present = [k for k in keys if k in df.columns]
    # Rows first collapse to one per key, inside the map tasks as far as possible, so the
    # exact distinct count needs no wider shuffle than the keys.
    per_key = df.groupBy(*present).agg(F.count("*").alias("_n"))
    rows = F.coalesce(F.sum("_n"), F.lit(0))
    nulls = [
        F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("_n"))), F.lit(0)).alias(f"nulls_{k}")
        for k in present
    ]
    report = per_key.agg(rows.alias("rows"), *nulls, (rows - F.count("*")).alias("duplicates"))
    return _long(report, "check_name", "value")
