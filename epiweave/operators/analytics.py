"""Reports over the (filtered) master table.

Each report aggregates first and ranks or reshapes the small result. A missing sum counts as 0,
and ties are settled by name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiweave.fixed import (
    DIRECTION_DOWN,
    DIRECTION_SAME,
    DIRECTION_UP,
    SUMMARY_METRICS,
    TARGET_DISEASES,
    TOP_MUNICIPALITIES,
    TOP_TREND_SERIES,
    WEEKLY_TAIL,
)
from epiweave.functions.convert import bankers, to_double, week_label
from epiweave.session import materialize

CASES = "casos_totales"


def total(value: Column | str = CASES) -> Column:
    """Sum that is 0 where there is nothing to add."""
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def cases_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(total().alias("casos"))


def _top(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return df.orderBy(F.col("casos").desc(), *[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def kpi_totals(df: DataFrame) -> DataFrame:
    """One row: rows, cases, distinct municipalities."""
    return df.agg(
        F.count("*").alias("filas"), total().alias("casos"),
        F.count_distinct("municipio").alias("municipios"),
    )


def outbreak_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("brote").agg(F.count("*").alias("filas")).orderBy(F.col("brote").asc_nulls_last())


def disease_stats(df: DataFrame) -> DataFrame:
    stats = df.groupBy("enfermedad").agg(total().alias("casos"), F.count("*").alias("filas"))
    return stats.orderBy(F.col("casos").desc(), F.col("enfermedad").asc_nulls_last())


def metric_means(df: DataFrame, metrics: list[str] = SUMMARY_METRICS) -> DataFrame:
    """One row of means with two decimals; null where a metric has no number."""
    present = [m for m in metrics if m in df.columns]
    return df.agg(*[bankers(F.avg(to_double(F.col(m))), 2).alias(m) for m in present])


def weekly_cases(df: DataFrame, last: int = WEEKLY_TAIL) -> DataFrame:
    """The last ``last`` weeks that have rows, oldest first, labelled ``YYYY-Www``."""
    newest = cases_by(df, "ano", "semana").orderBy(F.col("ano").desc(), F.col("semana").desc()).limit(last)
    return newest.select(
        "ano", "semana", week_label(F.col("ano"), F.col("semana")).alias("label"), "casos"
    ).orderBy("ano", "semana")


def top_municipalities(df: DataFrame, n: int = TOP_MUNICIPALITIES) -> DataFrame:
    return _top(cases_by(df, "departamento", "municipio"), ["departamento", "municipio"], n)


def top_value(df: DataFrame, column: str) -> DataFrame:
    """The value of a column with most cases."""
    return _top(cases_by(df, column), [column], 1)


def top_region(df: DataFrame) -> DataFrame:
    return top_value(df, "departamento")


def top_disease(df: DataFrame) -> DataFrame:
    return top_value(df, "enfermedad")


def top_year(df: DataFrame) -> DataFrame:
    return top_value(df, "ano")


def top_municipality(df: DataFrame) -> DataFrame:
    return top_value(df, "municipio")


def change_columns(value: str = "casos", when: Column | None = None) -> list[Column]:
    """Aggregates for the first and last year of yearly sums; ``when`` restricts the rows."""
    year, cases = F.col("ano"), F.col(value)
    if when is not None:
        year, cases = F.when(when, year), F.when(when, cases)
    return [
        F.count_distinct(year).alias("anos"),
        F.min(year).alias("from_year"), F.max(year).alias("to_year"),
        F.min_by(cases, year).alias("from_cases"), F.max_by(cases, year).alias("to_cases"),
    ]


def change_pct(decimals: int | None = 1) -> Column:
    """Change in percent from first to last year; null when the first year has no cases."""
    first, last = F.col("from_cases"), F.col("to_cases")
    pct = F.when(first > 0, (last - first) * F.lit(100.0) / first)
    return pct if decimals is None else bankers(pct, decimals)


def direction() -> Column:
    first, last = F.col("from_cases"), F.col("to_cases")
    return (
        F.when(last > first, DIRECTION_UP).when(last < first, DIRECTION_DOWN)
        .when(last == first, DIRECTION_SAME)
    )


def yearly_variation(df: DataFrame) -> DataFrame:
    """Change of cases between the first and the last year; no row with fewer than two years."""
    return (
        cases_by(df.where(F.col("ano").isNotNull()), "ano").agg(*change_columns())
        .where(F.col("anos") >= 2)
        .select(
            "from_year", "to_year", "from_cases", "to_cases",
            change_pct().alias("pct"), direction().alias("direction"),
        )
    )


def trend_top(df: DataFrame, n: int = TOP_TREND_SERIES) -> DataFrame:
    """Cases per year of the ``n`` diseases with most cases; a year without rows shows 0."""
    yearly = cases_by(df, "ano", "enfermedad").where(F.col("ano").isNotNull())
    years = yearly.agg(F.array_sort(F.collect_set("ano")).alias("anos"))
    series = (
        yearly.where(F.col("enfermedad").isNotNull())
        .groupBy("enfermedad")
        .agg(
            F.sum("casos").alias("total"),
            F.map_from_entries(F.collect_list(F.struct("ano", "casos"))).alias("by_year"),
        )
        .orderBy(F.col("total").desc(), "enfermedad").limit(n)
    )
    return (
        series.withColumn("anos", years.scalar())
        .withColumn("ano", F.explode("anos"))
        .select(
            "enfermedad", "ano",
            F.coalesce(F.try_element_at("by_year", "ano"), F.lit(0)).cast("bigint").alias("casos"),
        )
    )


def geo_pivot(df: DataFrame, diseases: list[str] = TARGET_DISEASES) -> DataFrame:
    """Cases per region with a column per listed disease and their sum, largest first.

    Rows of other diseases are left out, and so is the null region. If no row has a listed
    disease, the result is the plain total per region with zeros per disease. Both readings and
    whether any row has a listed disease come from one aggregation: the flag is the largest of the regions' flags.
    """
    kind = F.upper(F.trim(F.col("enfermedad")))
    listed = kind.isin(diseases)
    per_region = materialize(df.groupBy("departamento").agg(
        F.max(F.coalesce(listed, F.lit(False))).alias("_has_listed"),
        total().alias("_all"),
        *[total(F.when(kind == d, F.col(CASES))).alias(d.lower()) for d in diseases],
    ), "per-region")
    any_listed = per_region.agg(F.max("_has_listed")).scalar()
    columns = [F.col(d.lower()) for d in diseases]
    return (
        per_region.withColumn("_any", any_listed)
        .where(~F.col("_any") | (F.col("_has_listed") & F.col("departamento").isNotNull()))
        .withColumn("casos", F.when(F.col("_any"), reduce(lambda a, b: a + b, columns)).otherwise(F.col("_all")))
        .select("departamento", "casos", *columns)
        .orderBy(F.col("casos").desc(), F.col("departamento").asc_nulls_last())
    )


def geo_share_of_max(df: DataFrame) -> DataFrame:
    """Cases per region as a share of the largest region, the divisor never below 1."""
    per_region = cases_by(df.where(F.col("departamento").isNotNull()), "departamento")
    largest = per_region.agg(F.max("casos")).scalar()
    return per_region.withColumn("share", F.col("casos") / F.greatest(F.lit(1), largest))


def fastest_growing(df: DataFrame) -> DataFrame:
    """The disease with the largest relative growth between its first and last year."""
    yearly = cases_by(df.where(F.col("enfermedad").isNotNull() & F.col("ano").isNotNull()), "enfermedad", "ano")
    return (
        yearly.groupBy("enfermedad").agg(*change_columns())
        .where((F.col("anos") >= 2) & (F.col("from_cases") > 0))
        .withColumn("_pct", change_pct(None))
        .orderBy(F.col("_pct").desc(), "enfermedad").limit(1)
        .select("enfermedad", bankers(F.col("_pct"), 1).alias("pct"), "from_year", "to_year")
    )


def compare_categories(df: DataFrame, selected: list[str] | None = None) -> DataFrame:
    """Cases, first-to-last-year change and top region of each disease, side by side.

    ``selected`` limits the comparison and needs at least two names. One grouping-sets pass
    yields the sums per year and per region together.
    """
    if selected is not None:
        if len(set(selected)) < 2:
            raise ValueError("a comparison needs at least two diseases")
        df = df.where(F.col("enfermedad").isin(sorted(set(selected))))
    cols = [F.col(c) for c in ("enfermedad", "ano", "departamento")]
    disease, year, region = cols
    sums = df.where(disease.isNotNull()).groupingSets([[disease, year], [disease, region]], *cols).agg(
        total().alias("casos"), F.grouping("ano").alias("_per_region")
    )
    per_year = (F.col("_per_region") == 0) & F.col("ano").isNotNull()
    rank = F.when(F.col("_per_region") == 1, F.struct(-F.col("casos"), F.col("departamento").isNull(), "departamento"))
    return (
        sums.groupBy("enfermedad")
        .agg(
            F.sum(F.when(F.col("_per_region") == 0, F.col("casos"))).cast("bigint").alias("casos"),
            *change_columns(when=per_year),
            F.min_by("departamento", rank).alias("top_departamento"),
        )
        .select(
            "enfermedad", "casos", "top_departamento", "from_year", "to_year",
            F.when(F.col("anos") >= 2, change_pct()).alias("pct"),
            F.when(F.col("anos") >= 2, direction()).alias("direction"),
        )
    )


def facet_values(df: DataFrame, facets: tuple[str, ...] = ("departamento", "enfermedad", "ano", "brote")) -> DataFrame:
    """Distinct values of each facet as (facet, value) text rows, blanks left out.

    All facets are read in one scan. Rows are reduced to distinct combinations before they are spread
    into values, and those again to distinct ones.
    """
    present = [c for c in facets if c in df.columns]
    df = df.select(*present).distinct()
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in present])
    return (
        df.select(F.inline(pairs)).where(F.trim("value") != "").distinct().orderBy("facet", "value")
    )


def table_meta(df: DataFrame) -> DataFrame:
    """Columns with position and type, and the row count on each row."""
    described = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"))
        for i, f in enumerate(df.schema.fields, start=1)
    ])
    return df.agg(F.count("*").alias("total_rows")).select(F.inline(described), "total_rows")
