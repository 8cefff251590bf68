"""Conformed and serving tables of a data folder, built once per application and then read."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from epiweave.operators import paging
from epiweave.operators.filters import TEXT_COLUMNS, with_match_keys
from epiweave.plans import conformed, master
from epiweave.schemas import MASTER, MASTER_KEYS
from epiweave.session import stored_table, together
from epiweave.sources import star


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(
        spark, "cases", sf_dir, lambda: conformed.surveillance_weekly(star.raw_surveillance(spark, sf_dir))
    )


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(spark, "climate", sf_dir, lambda: conformed.climate_weekly(star.raw_climate(spark, sf_dir)))


def air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(spark, "air", sf_dir, lambda: conformed.air_quality_yearly(star.raw_air(spark, sf_dir)))


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(
        spark, "providers", sf_dir, lambda: conformed.providers_per_place(star.raw_providers(spark, sf_dir))
    )


def sources(spark: SparkSession, sf_dir: str) -> master.Conformed:
    jobs = {"cases": cases, "climate": climate, "air": air, "providers": providers}
    return master.Conformed(**together({name: partial(job, spark, sf_dir) for name, job in jobs.items()}))


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(
        spark, "geo", sf_dir,
        lambda: master.coordinate_reference(climate(spark, sf_dir), air(spark, sf_dir)),
    )


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master rows before the quality filters."""
    return stored_table(spark, "joined", sf_dir, lambda: master.master_joined(sources(spark, sf_dir)))


def serving_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master table partitioned by year, with comparison keys stored next to the text columns."""
    return stored_table(
        spark, "serving", sf_dir,
        lambda: with_match_keys(master.clean_master(joined(spark, sf_dir)), TEXT_COLUMNS + ["brote"])
        .hint("rebalance", "ano"),
        partition_by=["ano"],
    )


def serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving_keyed(spark, sf_dir).select(*MASTER.fieldNames())


def page_index(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame], keys: list[str], rows_per_range: int) -> paging.PageIndex:
    """A position index that is stored once, with its list of ranges."""
    stored = stored_table(spark, f"{name}-rows", sf_dir, lambda: paging.index_rows(rows(), keys, rows_per_range), partition_by=["_range"])
    ranges = stored_table(spark, f"{name}-ranges", sf_dir, lambda: paging.index_ranges(stored, keys))
    return paging.PageIndex(stored, ranges, [*keys, *(c for c in stored.columns if c not in (*keys, *paging.INDEX_COLUMNS))])


def serving_index(spark: SparkSession, sf_dir: str) -> paging.PageIndex:
    """The master table by its keys."""
    return page_index(spark, sf_dir, "serving-pages", lambda: serving(spark, sf_dir), MASTER_KEYS, 20_000)
