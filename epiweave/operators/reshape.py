"""Reshaping between months, years and weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epiweave.fixed import MONTHS, WEEKS_PER_MONTH, WEEKS_PER_YEAR


def month_weeks() -> list[tuple[str, int]]:
    """(month, week) pairs: four weeks a month, and December takes the rest of the year."""
    first = {m: i * WEEKS_PER_MONTH + 1 for i, m in enumerate(MONTHS)}
    last = {m: first[m] + WEEKS_PER_MONTH - 1 for m in MONTHS}
    last[MONTHS[-1]] = WEEKS_PER_YEAR
    return [(m, w) for m in MONTHS for w in range(first[m], last[m] + 1)]


def month_week_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(month_weeks(), "month_name string, semana int")


def unpivot_months(
    df: DataFrame, ids: list[str], value: str = "valor", months: list[str] = MONTHS
) -> DataFrame:
    """Twelve month columns → rows of (month_name, value). Values widen to double first."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in months])
    return wide.unpivot(ids, months, "month_name", value)


def months_to_weeks(df: DataFrame) -> DataFrame:
    """Repeat each month row for its weeks. The map is 52 rows by definition, so it is sent
    to every executor."""
    weeks = F.broadcast(month_week_table(df.sparkSession))
    return df.join(weeks, "month_name").drop("month_name")


def expand_weeks(df: DataFrame, week: str = "semana") -> DataFrame:
    """Repeat each yearly row for weeks 1 to 52."""
    return df.withColumn(week, F.explode(F.sequence(F.lit(1), F.lit(WEEKS_PER_YEAR))))


def pivot_mean(
    df: DataFrame, keys: list[str], category: str, categories: list[str], value: str
) -> DataFrame:
    """One column per listed category with the mean of ``value``. Naming the categories spares
    Spark a job to find them."""
    return df.groupBy(*keys).pivot(category, categories).agg(F.avg(value))


def shift_week(year: Column, week: Column, steps: Column | int) -> tuple[Column, Column]:
    """Year and week ``steps`` weeks later in a 52-week calendar."""
    index = week - 1 + steps
    return (
        (year + F.floor(index / WEEKS_PER_YEAR)).cast("int"),
        (F.pmod(index, F.lit(WEEKS_PER_YEAR)) + 1).cast("int"),
    )
