"""Filters over the master table: one optional predicate per field, combined by AND."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.functions.text import match_key, match_key_py

TEXT_COLUMNS = ["departamento", "municipio", "enfermedad"]
KEY_SUFFIX = "_key"


@dataclass(frozen=True)
class FilterSpec:
    """Selection of a query; an unset field filters nothing.

    ``q`` is searched as a regular expression unless ``literal`` is set.
    """

    q: str = ""
    literal: bool = False
    departamento: list[str] = field(default_factory=list)
    municipio: str = ""
    enfermedad: list[str] = field(default_factory=list)
    brote: str = ""
    ano: int | None = None
    ano_min: int | None = None
    ano_max: int | None = None
    semana: int | None = None

    def __post_init__(self):
        for name in ("ano", "ano_min", "ano_max", "semana"):
            value = getattr(self, name)
            if value is not None and (isinstance(value, bool) or not isinstance(value, int)):
                raise TypeError(f"{name} must be an integer, got {value!r}")
        if self.q.strip() and not self.literal:
            check_pattern(self.q)


def check_pattern(q: str) -> None:
    """Raise for a pattern that the executors' grammar, Java's, does not accept."""
    context = SparkContext._active_spark_context
    if context is not None:
        context._jvm.java.util.regex.Pattern.compile("(?iu)" + q.strip())


def filter_categories(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(F.col(column).isin(values))


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def text_search(columns: list[str], q: str, literal: bool = False) -> Column:
    """True where any column contains the search text or pattern, whatever the case; null text never matches."""
    needle = q.strip()

    def hit(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.upper(value).contains(needle.upper()) if literal else value.rlike("(?iu)" + needle)

    return _any([F.coalesce(hit(c), F.lit(False)) for c in columns])


def search_text(df: DataFrame, q: str, columns: list[str] | None = None, literal: bool = False) -> DataFrame:
    present = [c for c in (columns or TEXT_COLUMNS) if c in df.columns]
    if not q.strip():
        return df
    if not present:
        return df.where(F.lit(False))
    if not literal:
        check_pattern(q)
    return df.where(text_search(present, q, literal))


def key_of(df: DataFrame, column: str) -> Column:
    """Comparison key of a column: the stored key where the table keeps one, so that the filter
    reaches the Parquet scan, else computed."""
    stored = column + KEY_SUFFIX
    return F.col(stored) if stored in df.columns else match_key(F.col(column).cast("string"))


def with_match_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the comparison keys that :func:`key_of` looks for."""
    return df.withColumns({c + KEY_SUFFIX: match_key(c) for c in columns})


def filter_set_normalized(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    keys = sorted({match_key_py(v) for v in values})
    return df.where(key_of(df, column).isin(keys))


def filter_eq_normalized(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(key_of(df, column) == match_key_py(value))


def filter_years(
    df: DataFrame, ano: int | None = None, ano_min: int | None = None, ano_max: int | None = None,
    semana: int | None = None,
) -> DataFrame:
    """Year equality, closed year range and week equality; prunes partitions of the year."""
    tests = []
    if "ano" in df.columns:
        if ano is not None:
            tests.append(F.col("ano") == ano)
        if ano_min is not None:
            tests.append(F.col("ano") >= ano_min)
        if ano_max is not None:
            tests.append(F.col("ano") <= ano_max)
    if semana is not None and "semana" in df.columns:
        tests.append(F.col("semana") == semana)
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """All set fields of ``spec``; a field whose column is absent is ignored."""
    out = filter_years(df, spec.ano, spec.ano_min, spec.ano_max, spec.semana)
    for column, values in (("departamento", spec.departamento), ("enfermedad", spec.enfermedad)):
        if values and column in df.columns:
            out = filter_set_normalized(out, column, values)
    for column, value in (("municipio", spec.municipio), ("brote", spec.brote)):
        if value.strip() and column in df.columns:
            out = filter_eq_normalized(out, column, value)
    return search_text(out, spec.q, literal=spec.literal)
