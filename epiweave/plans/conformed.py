"""One job per raw source: clean, conform and aggregate to the source's grain.

Raw rows are first aggregated by their raw spellings, mostly inside the map tasks, and text rules run on what is left: no raw row is
cleaned on its own. Where spellings repeat over weeks, they go through a dictionary of distinct ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.fixed import AIR_TEMPERATURES, CLIMATE_PARAMETERS, MONTHS, POLLUTANTS, REGION_NAMES, TARGET_DISEASES
from epiweave.functions.convert import to_int
from epiweave.functions.text import harmonize, normalize_text
from epiweave.operators import cleaning
from epiweave.operators.reshape import expand_weeks, months_to_weeks
from epiweave.session import broadcast_if_small, materialize

PLACE = ["departamento", "municipio"]


def _place(dept: str, muni: str, names: dict[str, str]) -> list:
    """Conformed place columns. Every source takes the same region names, so that place keys
    agree across sources."""
    return [
        harmonize(normalize_text(dept), names).alias("departamento"),
        normalize_text(muni).alias("municipio"),
    ]


def _sums(columns: list[str]) -> list[Column]:
    """Aggregates from which means can be made: sum and number of values of each column."""
    values = {c: F.col(c).cast("double") for c in columns}
    return [x for c, v in values.items() for x in (F.sum(v).alias(f"{c}_sum"), F.count(v).alias(f"{c}_n"))]


def _mean(column: str, when: Column | None = None) -> Column:
    """Mean over groups that :func:`_sums` made; null where there is no value."""
    total, n = F.col(f"{column}_sum"), F.col(f"{column}_n")
    if when is not None:
        total, n = F.when(when, total), F.when(when, n)
    return F.try_divide(F.sum(total), F.sum(n))


def by_spelling(rows: DataFrame, raw: list[str], conformed: list[Column]) -> DataFrame:
    """``rows`` with conformed columns in place of their raw ones.

    The rules run once for each distinct spelling. The dictionary is a stored table that is joined back: sent to all tasks if it is
    measured to be small, else by shuffling.
    """
    kept = [c for c in rows.columns if c not in raw]
    words = rows.select(*raw).distinct().select(*[F.col(c).alias(f"_{c}") for c in raw], *conformed)
    dictionary = materialize(words, "spellings")
    names = [c for c in dictionary.columns if c not in {f"_{r}" for r in raw}]
    spelled = rows.withColumnsRenamed({c: f"__{c}" for c in raw})
    same = reduce(lambda a, b: a & b, [F.col(f"__{c}").eqNullSafe(F.col(f"_{c}")) for c in raw])
    return spelled.join(broadcast_if_small(dictionary), same).select(*kept, *names)


def surveillance_weekly(
    raw: DataFrame, diseases: list[str] = TARGET_DISEASES, names: dict[str, str] = REGION_NAMES
) -> DataFrame:
    """Cases per (year, week, region, municipality, disease).

    Rows are first summed per distinct raw spelling and week, mostly inside the map tasks; a key that holds a large
    share of the rows leaves each map task as a single row. These sums are stored, the text rules run once per spelling in
    a dictionary of them, and spellings that conform to the same place are then summed together.
    """
    raw = cleaning.normalize_headers(raw)
    text = ["departamento_ocurrencia", "municipio_ocurrencia", "nombre_evento"]
    spelled = raw.groupBy("ano", "semana", *text).agg(F.sum(to_int(F.col("conteo"))).alias("conteo"))
    conformed = [*_place("departamento_ocurrencia", "municipio_ocurrencia", names), normalize_text("nombre_evento").alias("enfermedad")]
    return (
        by_spelling(materialize(spelled, "spelled"), text, conformed)
        .where(F.col("enfermedad").isin(diseases))
        .groupBy(to_int(F.col("ano")).alias("ano"), to_int(F.col("semana")).alias("semana"), *PLACE, "enfermedad")
        .agg(F.sum("conteo").alias("casos_totales"))
    )


def climate_weekly(
    raw: DataFrame, parameters: dict[str, str] = CLIMATE_PARAMETERS, names: dict[str, str] = REGION_NAMES
) -> DataFrame:
    """Climate measures and position per (week, region, municipality).

    All weeks of a month share their value, so stations are averaged in the wide month form, by sums and counts per raw
    spelling and then per place, and only the result is spread over months and weeks. A
    place's position is the mean over its parameters of their station means.
    """
    raw = cleaning.normalize_headers(raw)
    measures = list(dict.fromkeys(parameters.values()))
    spelled = raw.groupBy("departamento", "municipio", "par_metro").agg(*_sums([*MONTHS, "latitud", "longitud"]))
    rows = spelled.select(
        *_place("departamento", "municipio", names),
        cleaning.category_by_substring(normalize_text("par_metro"), parameters).alias("medida"),
        *[c for c in spelled.columns if c.endswith(("_sum", "_n"))],
    )

    def mean_of(measure: str, column: str):
        return _mean(column, F.col("medida") == measure)

    # Places without a listed parameter are dropped by a count and not by a filter on the rows:
    # Catalyst would move such a filter, text rules included, below the first aggregation.
    per_place = rows.groupBy(*PLACE).agg(
        F.count("medida").alias("_listed"),
        *[mean_of(m, month).alias(f"{m}_{month}") for m in measures for month in MONTHS],
        *[mean_of(m, axis).alias(f"{axis}_{m}") for m in measures for axis in ("latitud", "longitud")],
    ).where(F.col("_listed") > 0)

    def over_parameters(axis: str):
        present = F.filter(F.array(*[F.col(f"{axis}_{m}") for m in measures]), lambda v: v.isNotNull())
        added = F.aggregate(present, F.lit(0.0), lambda acc, v: acc + v)
        return F.when(F.size(present) > 0, added / F.size(present)).alias(axis)

    by_month = F.array(*[
        F.struct(F.lit(month).alias("month_name"), *[F.col(f"{m}_{month}").alias(m) for m in measures])
        for month in MONTHS
    ])
    monthly = per_place.select(*PLACE, over_parameters("latitud"), over_parameters("longitud"), F.inline(by_month))
    return months_to_weeks(monthly).select("semana", *PLACE, *measures, "latitud", "longitud")


def air_quality_yearly(
    raw: DataFrame, pollutants: list[str] = POLLUTANTS, temperatures: list[str] = AIR_TEMPERATURES,
    names: dict[str, str] = REGION_NAMES,
) -> DataFrame:
    """Mean pollutant level, mean air temperature and position per (year, region, municipality)."""
    raw = cleaning.normalize_headers(raw)
    spelled = raw.where(F.col("variable").isin(pollutants + temperatures)).groupBy(
        "a_o", "nombre_del_departamento", "nombre_del_municipio", "variable"
    ).agg(*_sums(["promedio", "latitud", "longitud"]))
    kind = cleaning.category_by_membership("variable", {"aire": pollutants, "temperatura": temperatures})
    rows = spelled.select(
        to_int(F.col("a_o")).alias("ano"),
        *_place("nombre_del_departamento", "nombre_del_municipio", names),
        kind.alias("tipo"), *[c for c in spelled.columns if c.endswith(("_sum", "_n"))],
    )
    return rows.groupBy("ano", *PLACE).agg(
        _mean("promedio", F.col("tipo") == "aire").alias("calidad_aire_promedio"),
        _mean("promedio", F.col("tipo") == "temperatura").alias("temperatura_promedio_aire"),
        _mean("latitud").alias("latitud_aire"),
        _mean("longitud").alias("longitud_aire"),
    )


def air_quality_weekly(raw: DataFrame, **options) -> DataFrame:
    """Yearly air quality repeated for weeks 1 to 52."""
    return expand_weeks(air_quality_yearly(raw, **options))


def providers_per_place(raw: DataFrame, names: dict[str, str] = REGION_NAMES) -> DataFrame:
    """Named providers per place. Counted per raw spelling first, as in the surveillance job."""
    raw = cleaning.normalize_headers(raw)
    spelled = raw.groupBy("departamentoprestadordesc", "municipioprestadordesc").agg(
        F.count("nombreprestador").alias("n")
    )
    return (
        spelled.select(*_place("departamentoprestadordesc", "municipioprestadordesc", names), "n")
        .groupBy(*PLACE).agg(F.sum("n").alias("cantidad_hospitales"))
    )
