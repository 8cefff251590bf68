"""The master table: cases with climate, air quality, providers, position and outbreak label."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.fixed import IMPUTE_RADIUS_KM, MASTER_DECIMALS, VACCINATION_CONSTANT, WEEKS_PER_YEAR
from epiweave.operators import cleaning, quality
from epiweave.operators.joins import PLACE, impute_from_neighbor, left_join_dims
from epiweave.operators.label import outbreak_label
from epiweave.operators.nearest import nearest_within
from epiweave.plans import conformed
from epiweave.schemas import MASTER
from epiweave.session import materialize, together


@dataclass(frozen=True)
class Conformed:
    """The four conformed sources; air quality stays yearly."""

    cases: DataFrame
    climate: DataFrame
    air: DataFrame
    providers: DataFrame


def conform(surveillance: DataFrame, climate: DataFrame, air: DataFrame, providers: DataFrame) -> Conformed:
    """Run the source jobs once and store their results. Each is read several times below, and
    the raw sources are by far the larger side. The jobs do not depend on each other and are
    submitted together, so small ones fill the executors a large one leaves idle."""
    jobs = {
        "cases": lambda: conformed.surveillance_weekly(surveillance),
        "climate": lambda: conformed.climate_weekly(climate),
        "air": lambda: conformed.air_quality_yearly(air),
        "providers": lambda: conformed.providers_per_place(providers),
    }
    return Conformed(**together({name: partial(_stored, name, job) for name, job in jobs.items()}))


def _stored(name: str, job: Callable[[], DataFrame]) -> DataFrame:
    return materialize(job(), name)


def climate_places(climate: DataFrame) -> DataFrame:
    """One position per climate place; the position does not vary over weeks."""
    return climate.select(*PLACE, "latitud", "longitud").distinct()


def air_places(air: DataFrame) -> DataFrame:
    return air.select(
        *PLACE, F.col("latitud_aire").alias("latitud"), F.col("longitud_aire").alias("longitud")
    ).distinct()


def coordinate_reference(climate: DataFrame, air: DataFrame) -> DataFrame:
    """Mean position of each place over its distinct positions in both sources."""
    return (
        climate_places(climate).unionByName(air_places(air))
        .groupBy(*PLACE).agg(F.avg("latitud").alias("latitud"), F.avg("longitud").alias("longitud"))
    )


def neighbor_maps(src: Conformed, geo: DataFrame, max_km: float = IMPUTE_RADIUS_KM) -> tuple[DataFrame, DataFrame]:
    """Nearest climate place and nearest air place of each surveillance place, stored: a row per
    place at most, and each is joined to every case."""
    targets = src.cases.select(*PLACE).distinct().join(geo, PLACE)
    found = together({
        "climate": lambda: materialize(nearest_within(targets, climate_places(src.climate), max_km), "near-climate"),
        "air": lambda: materialize(nearest_within(targets, air_places(src.air), max_km), "near-air"),
    })
    return found["climate"], found["air"]


def master_joined(src: Conformed, max_km: float = IMPUTE_RADIUS_KM) -> DataFrame:
    """Cases with all measures attached, before quality filters, in the master schema."""
    geo = materialize(coordinate_reference(src.climate, src.air), "geo")
    to_climate, to_air = neighbor_maps(src, geo, max_km)
    climate = src.climate.withColumnsRenamed({"latitud": "latitud_clima", "longitud": "longitud_clima"})
    labelled = outbreak_label(src.cases.fillna(0, ["casos_totales"]), base=src.cases)
    joined = impute_from_neighbor(labelled, to_climate, climate, ["semana"], src.cases)
    joined = impute_from_neighbor(joined, to_air, src.air, ["ano"], src.cases)
    # Air rows stand for weeks 1 to 52, so a later week finds none.
    in_year = F.col("semana").between(1, WEEKS_PER_YEAR)
    air_values = [c for c in src.air.columns if c not in PLACE + ["ano"]]
    joined = joined.withColumns({c: F.when(in_year, F.col(c)) for c in air_values})
    original = geo.withColumnsRenamed({"latitud": "latitud_original", "longitud": "longitud_original"})
    joined = left_join_dims(joined, [original, src.providers])
    merged = cleaning.coalesce_sources(joined, {
        "temperatura_promedio": ["temperatura_promedio", "temperatura_promedio_aire"],
        "latitud": ["latitud_original", "latitud_clima", "latitud_aire"],
        "longitud": ["longitud_original", "longitud_clima", "longitud_aire"],
    })
    filled = cleaning.fill_nulls(merged, {"cantidad_hospitales": 0})
    constant = cleaning.add_constant(filled, "vacunacion", VACCINATION_CONSTANT)
    return cleaning.enforce_schema(cleaning.round_metrics(constant, MASTER_DECIMALS), MASTER)


def clean_master(joined: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Complete and plausible rows. No two are equal: cases are unique by key, and each table that
    is joined to them is unique by what it is joined on."""
    return quality.sanity_filters(quality.drop_incomplete(joined, required))


def master_dataset(
    surveillance: DataFrame, climate: DataFrame, air: DataFrame, providers: DataFrame,
    max_km: float = IMPUTE_RADIUS_KM, required: list[str] | None = None,
) -> DataFrame:
    """Raw sources → master table."""
    src = conform(surveillance, climate, air, providers)
    return clean_master(master_joined(src, max_km), required)
