"""Results as nested JSON records: a page with its total, and the summary of a selection. Nulls are kept as nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.fixed import PAGE_MAX_ROWS, SUMMARY_METRICS, TOP_MUNICIPALITIES, WEEKLY_TAIL
from epiweave.functions.convert import bankers, week_label
from epiweave.operators.paging import PageIndex
from epiweave.plans.summary import Cube, change_of_years, largest, sentences, summary_cube, trend


def as_json(record: Column) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false"})


def page_record(index: PageIndex, offset: int = 0, limit: int = 100, where: Column | str | None = None, max_rows: int = PAGE_MAX_ROWS) -> DataFrame:
    """One row ``payload``: columns, rows in their order, offset, limit and the number of all rows that fulfil ``where``."""
    page = index.page(offset, limit, where, max_rows)
    rows = page.withColumn("_at", F.monotonically_increasing_id())  # a page is one sorted partition
    ordered = F.array_sort(F.collect_list(F.struct("_at", F.struct(*page.columns).alias("row"))))
    total = index.ranges.agg(F.sum("rows")) if where is None else index.rows.where(where).agg(F.count("*"))
    record = F.struct(
        F.array(*map(F.lit, page.columns)).alias("columns"), F.transform(ordered, lambda r: r["row"]).alias("rows"),
        F.lit(max(0, offset)).alias("offset"), F.lit(max(1, limit)).alias("limit"), F.coalesce(total.scalar(), F.lit(0)).alias("filtered_total"),
    )
    return rows.agg(as_json(record).alias("payload"))


def _listed(rows: DataFrame, order: list[Column], *fields: Column | str) -> Column:
    """Rows as an array of records, in the given order, as a value of its own."""
    keys = [key.alias(f"_{i}") for i, key in enumerate(order)]
    held = F.array_sort(F.collect_list(F.struct(*keys, F.struct(*fields).alias("record"))))
    return rows.agg(F.transform(held, lambda r: r["record"])).scalar()


def _most(*names: str) -> list[Column]:
    """Order by cases, the largest first, then by names with nulls last."""
    return [-F.col("casos"), *[x for n in names for x in (F.col(n).isNull(), F.coalesce(F.col(n), F.lit("")))]]


def _trend_record(cube: Cube) -> Column:
    filled = trend(cube)
    series = filled.groupBy("enfermedad").agg(
        F.sum("casos").alias("casos"), F.transform(F.array_sort(F.collect_list(F.struct("ano", "casos"))), lambda r: r["casos"]).alias("data")
    )
    years = cube.at("ano").where("ano is not null").agg(F.transform(F.array_sort(F.collect_set("ano")), lambda y: y.cast("string"))).scalar()
    return F.struct(years.alias("labels"), _listed(series, _most("enfermedad"), F.col("enfermedad").alias("name"), "data").alias("series"))


def summary_record(df: DataFrame, metrics: list[str] = SUMMARY_METRICS) -> DataFrame:
    """One row ``payload``: all blocks of the summary of a selection, from one pass over its rows.

    A selection without rows has zeros, empty lists and nulls. A null flag is counted under ``null``.
    """
    cube = summary_cube(df, metrics)
    everything, diseases = cube.at("all"), cube.at("enfermedad")
    flags = cube.at("brote").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("brote", F.lit("null")), "filas"))))).scalar()
    weeks = cube.at("semana").orderBy(F.col("ano").desc(), F.col("semana").desc()).limit(WEEKLY_TAIL)
    places = largest(cube.at("lugar"), ["departamento", "municipio"], TOP_MUNICIPALITIES)
    means = everything.select(F.struct(*[bankers(F.col(m), 2).alias(m) for m in metrics])).scalar()
    none = F.struct(*[F.lit(None).cast("double").alias(m) for m in metrics])
    change = change_of_years(cube).select(F.struct("from_year", "to_year", "from_cases", "to_cases", "pct", "direction")).scalar()
    zero = F.lit(0)
    record = F.struct(
        F.coalesce(everything.select("filas").scalar(), zero).alias("filtered_total_rows"),
        F.coalesce(everything.select("casos").scalar(), zero).alias("total_cases"),
        cube.at("municipio").agg(F.count("municipio")).scalar().alias("municipios"),
        flags.alias("brote_counts"),
        _listed(diseases, _most("enfermedad"), "enfermedad", "casos", "filas").alias("disease_stats"),
        _listed(weeks, [F.col("ano"), F.col("semana")], week_label(F.col("ano"), F.col("semana")).alias("label"), "casos").alias("weekly_cases"),
        _listed(places, _most("departamento", "municipio"), "departamento", "municipio", "casos").alias("top_municipios"),
        F.coalesce(means, none).alias("metrics"),
        largest(diseases, ["enfermedad"], 1).select("enfermedad").scalar().alias("top_enfermedad"),
        largest(cube.at("departamento"), ["departamento"], 1).select("departamento").scalar().alias("top_departamento"),
        change.alias("variation"),
        sentences(cube).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda r: r["text"])).scalar().alias("insights"),
        _trend_record(cube).alias("trend"),
    )
    return df.sparkSession.range(1).select(as_json(record).alias("payload"))
