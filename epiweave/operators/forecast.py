"""Short linear forecast of weekly cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiweave.fixed import FORECAST_HISTORY, FORECAST_STEPS, WEEKS_PER_YEAR
from epiweave.functions.convert import bankers, to_double, to_int, week_label
from epiweave.operators.reshape import shift_week


def forecast_weeks(
    df: DataFrame, by: list[str] | None = None, history: int = FORECAST_HISTORY, steps: int = FORECAST_STEPS
) -> DataFrame:
    """Forecast the next weeks from the last ``history`` weeks that have data, per ``by`` group.

    The line runs from the first to the last of those weeks; forecasts are rounded half-even
    and never negative. Weeks outside 1..52 are left out. Groups reach the window as weekly
    sums, a row per week, so no group is large.
    """
    by = by or []
    zero = F.lit(0)
    weekly = (
        df.groupBy(*by, "ano", "semana").agg(F.sum("casos_totales").alias("casos"))
        .select(
            *by,
            F.coalesce(to_int(F.col("ano")), zero).alias("ano"),
            F.coalesce(to_int(F.col("semana")), zero).alias("semana"),
            F.coalesce(to_double(F.col("casos")), F.lit(0.0)).alias("casos"),
        )
        .where(F.col("semana").between(1, WEEKS_PER_YEAR))
    )
    newest = [F.col("ano").desc(), F.col("semana").desc()]
    if by:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*newest))
        tail = weekly.withColumn("_rank", rank).where(F.col("_rank") <= history)
    else:
        tail = weekly.orderBy(*newest).limit(history)
    when = F.struct("ano", "semana")
    fit = (
        tail.groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.avg("casos").alias("mean"),
            F.min_by("casos", when).alias("first"),
            F.max_by("casos", when).alias("last"),
            F.max(when).alias("end"),
        )
        .where(F.col("n") > 0)
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    )
    slope = F.when(F.col("n") < 2, F.lit(0.0)).otherwise(
        (F.col("last") - F.col("first")) / F.greatest(F.col("n") - 1, F.lit(1))
    )
    year, week = shift_week(F.col("end.ano"), F.col("end.semana"), F.col("step"))
    return fit.select(
        *by,
        year.alias("ano"),
        week.alias("semana"),
        week_label(year, week).alias("label"),
        F.greatest(zero, bankers(F.col("last") + slope * F.col("step"))).cast("bigint").alias("casos"),
        bankers(F.col("mean")).cast("bigint").alias("promedio_reciente"),
        F.col("n").cast("int").alias("semanas_usadas"),
    )
