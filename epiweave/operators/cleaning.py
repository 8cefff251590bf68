"""Projection and cleaning operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiweave.functions import text as tx
from epiweave.functions.convert import to_double, to_int


def rename_headers(df: DataFrame, rule=tx.header_name) -> DataFrame:
    """Apply a header rule to every column in one projection; a collision is an error."""
    names = [rule(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"headers collide after normalization: {clashes}")
    return df.toDF(*names)


def normalize_headers(df: DataFrame) -> DataFrame:
    return rename_headers(df, tx.header_name)


def normalize_headers_landing(df: DataFrame) -> DataFrame:
    return rename_headers(df, tx.landing_header_name)


def normalize_text(df: DataFrame, columns: list[str], fold_small_accents: bool = True) -> DataFrame:
    return df.withColumns({c: tx.normalize_text(c, fold_small_accents) for c in columns})


def project_cast(df: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """Select, convert and rename in one projection: ``{output: (input, type)}``.

    Conversions are tolerant: text that does not parse gives null.
    """

    def convert(source: str, kind: str) -> Column:
        if kind == "int":
            return to_int(F.col(source))
        if kind == "double":
            return to_double(F.col(source))
        return F.col(source).try_cast(kind)

    return df.select(*[convert(src, kind).alias(out) for out, (src, kind) in spec.items()])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def category_by_membership(col: Column | str, groups: dict[str, list[str]]) -> Column:
    """Label of the first value list that holds the value, else null."""
    value = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.when(value.isin(vals), label) for label, vals in groups.items()])


def category_by_substring(col: Column | str, labels: dict[str, str]) -> Column:
    """Label of the first substring found in the value, else null."""
    value = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.when(value.contains(part), label) for part, label in labels.items()])


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in order and typed; absent ones become typed nulls."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def add_constant(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def add_join_key(df: DataFrame, columns: list[str], name: str = "join_key") -> DataFrame:
    """Composite text key; null parts are left out of it."""
    return df.withColumn(name, F.concat_ws("_", *[F.col(c).cast("string") for c in columns]))


def fill_nulls(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.fillna(values)


def coalesce_sources(df: DataFrame, outputs: dict[str, list[str]]) -> DataFrame:
    """First non-null of several columns per output; the inputs that were merged are dropped."""
    merged = df.withColumns({out: F.coalesce(*map(F.col, cols)) for out, cols in outputs.items()})
    used = {c for cols in outputs.values() for c in cols} - set(outputs)
    return merged.drop(*used)


def round_metrics(df: DataFrame, decimals: dict[str, int]) -> DataFrame:
    """Half-up rounding to fixed decimals."""
    return df.withColumns({c: F.round(c, n) for c, n in decimals.items()})
