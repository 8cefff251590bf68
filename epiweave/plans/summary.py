"""The summary of a selection: every block of the report from one pass over its rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.fixed import (
    DIRECTION_DOWN,
    DIRECTION_UP,
    INSIGHT_DISEASE,
    INSIGHT_DOWN,
    INSIGHT_REGION,
    INSIGHT_SAME,
    INSIGHT_UP,
    SUMMARY_METRICS,
    TOP_MUNICIPALITIES,
    TOP_TREND_SERIES,
    WEEKLY_TAIL,
)
from epiweave.functions.convert import bankers, to_double, week_label
from epiweave.operators.analytics import change_columns, change_pct, direction, total
from epiweave.session import materialize

DIMENSIONS = ["ano", "semana", "departamento", "municipio", "enfermedad", "brote"]

# The groupings the blocks need, by name.
GROUPINGS = {
    "all": [],
    "brote": ["brote"],
    "enfermedad": ["enfermedad"],
    "semana": ["ano", "semana"],
    "lugar": ["departamento", "municipio"],
    "departamento": ["departamento"],
    "municipio": ["municipio"],
    "ano": ["ano"],
    "tendencia": ["ano", "enfermedad"],
}


def _grouping_id(columns: list[str]) -> int:
    """The grouping id Spark assigns: one bit per dimension, set when it is summed over."""
    return sum(0 if d in columns else 1 << (len(DIMENSIONS) - 1 - i) for i, d in enumerate(DIMENSIONS))


@dataclass(frozen=True)
class Cube:
    """Sums of a selection at each of the groupings. As many rows as there are groups."""

    rows: DataFrame

    def at(self, grouping: str) -> DataFrame:
        columns = GROUPINGS[grouping]
        return self.rows.where(F.col("gid") == _grouping_id(columns))


def summary_cube(df: DataFrame, metrics: list[str] = SUMMARY_METRICS) -> Cube:
    """Aggregate a selection once for all blocks, and store the small result.

    Map tasks combine their rows per group before the shuffle, the total included, so a
    dominant disease, place or year costs one row per task.
    """
    sets = [[F.col(c) for c in columns] for columns in GROUPINGS.values()]
    rows = df.groupingSets(sets, *[F.col(d) for d in DIMENSIONS]).agg(
        F.grouping_id().cast("int").alias("gid"),
        total().alias("casos"),
        F.count("*").alias("filas"),
        *[F.avg(to_double(F.col(m))).alias(m) for m in metrics],
    )
    return Cube(materialize(rows, "summary"))


def _facts(df: DataFrame, block: str, label: Column | str, value: Column) -> DataFrame:
    label = F.col(label) if isinstance(label, str) else label
    return df.select(F.lit(block).alias("block"), label.cast("string").alias("label"), value.cast("double").alias("value"))


def largest(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return df.orderBy(F.col("casos").desc(), *[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def trend(cube: Cube) -> DataFrame:
    """(ano, enfermedad, casos) of the diseases with most cases in rows with a year. Every year of the
    selection counts for each of them, with 0 where it has no rows."""
    yearly = cube.at("tendencia").where(F.col("ano").isNotNull())
    named = yearly.where(F.col("enfermedad").isNotNull())
    leading = largest(named.groupBy("enfermedad").agg(F.sum("casos").alias("casos")), ["enfermedad"], TOP_TREND_SERIES)
    years = cube.at("ano").where(F.col("ano").isNotNull()).agg(F.array_sort(F.collect_set("ano"))).scalar()
    all_years = leading.withColumn("anos", years).select("enfermedad", F.explode("anos").alias("ano"))
    filled = all_years.join(named.select("ano", "enfermedad", "casos"), ["ano", "enfermedad"], "left")
    return filled.select("ano", "enfermedad", F.coalesce("casos", F.lit(0)).alias("casos"))


def change_of_years(cube: Cube) -> DataFrame:
    yearly = cube.at("ano").where(F.col("ano").isNotNull())
    return yearly.agg(*change_columns()).where(F.col("anos") >= 2).select(
        "*", change_pct().alias("pct"), direction().alias("direction")
    )


def summary_long(df: DataFrame, metrics: list[str] = SUMMARY_METRICS) -> DataFrame:
    """All blocks of the summary as (block, label, value) rows. A sentence is the label of its row and the position its value."""
    cube = summary_cube(df, metrics)
    casos, filas = F.col("casos"), F.col("filas")
    everything = cube.at("all")
    weeks = cube.at("semana").orderBy(F.col("ano").desc(), F.col("semana").desc()).limit(WEEKLY_TAIL)
    place = F.concat_ws(" / ", "departamento", "municipio")
    top_places = largest(cube.at("lugar"), ["departamento", "municipio"], TOP_MUNICIPALITIES)
    variation = change_of_years(cube)
    blocks = [
        _facts(everything, "kpi", F.lit("filas"), filas),
        _facts(everything, "kpi", F.lit("casos"), casos),
        _facts(cube.at("municipio"), "kpi", F.lit("municipios"), F.count("municipio")),
        _facts(cube.at("brote"), "brote", "brote", filas),
        _facts(cube.at("enfermedad"), "enfermedad_casos", "enfermedad", casos),
        _facts(cube.at("enfermedad"), "enfermedad_filas", "enfermedad", filas),
        _facts(weeks, "semana", week_label(F.col("ano"), F.col("semana")), casos),
        _facts(top_places, "top_municipio", place, casos),
        *[_facts(everything, "promedio", F.lit(m), bankers(F.col(m), 2)) for m in metrics],
        _facts(largest(cube.at("enfermedad"), ["enfermedad"], 1), "top_enfermedad", "enfermedad", casos),
        _facts(largest(cube.at("departamento"), ["departamento"], 1), "top_departamento", "departamento", casos),
        _facts(variation, "variacion", "direction", F.col("pct")),
        *[_facts(variation, "variacion", F.lit(c), F.col(c)) for c in ("from_year", "to_year", "from_cases", "to_cases")],
        _facts(trend(cube), "tendencia", F.concat_ws("|", "ano", "enfermedad"), casos),
        _facts(sentences(cube), "frase", "text", F.col("position")),
    ]
    return reduce(DataFrame.unionByName, blocks)


def insights(df: DataFrame) -> DataFrame:
    """Sentences on the change over the years, the top disease and the top region, in order:
    (position, text). The first three are the short summary."""
    return sentences(summary_cube(df, []))


def sentences(cube: Cube) -> DataFrame:
    span = [F.col("from_year"), F.col("to_year")]
    change = (
        F.when(F.col("direction") == DIRECTION_UP, F.format_string(INSIGHT_UP, *span, F.col("pct")))
        .when(F.col("direction") == DIRECTION_DOWN, F.format_string(INSIGHT_DOWN, *span, F.abs("pct")))
        .otherwise(F.format_string(INSIGHT_SAME, *span))
    )
    top_disease = largest(cube.at("enfermedad"), ["enfermedad"], 1)
    top_region = largest(cube.at("departamento"), ["departamento"], 1)
    parts = [
        change_of_years(cube).where(F.col("pct").isNotNull()).select(F.lit(1).alias("position"), change.alias("text")),
        top_disease.select(F.lit(2).alias("position"), F.format_string(INSIGHT_DISEASE, "enfermedad").alias("text")),
        top_region.select(F.lit(3).alias("position"), F.format_string(INSIGHT_REGION, "departamento").alias("text")),
    ]
    return reduce(DataFrame.unionByName, parts)
