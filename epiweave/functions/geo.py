"""Great-circle distance in SQL text over column names.

A formula parsed from one string reaches the JVM in one call; built from Column operators it
takes dozens, and planning then outweighs small jobs.
"""

from __future__ import annotations

from epiweave.fixed import EARTH_RADIUS_KM


def km_of_angles(delta_lat: str, delta_lon: str, cos_product: str) -> str:
    """Kilometres from angle differences in degrees and the product of the latitudes' cosines.
    The haversine is kept at most 1: rounding noise above it would give NaN."""
    hav = (
        f"pow(sin(radians({delta_lat}) / 2), 2)"
        f" + {cos_product} * pow(sin(radians({delta_lon}) / 2), 2)"
    )
    return f"{2 * EARTH_RADIUS_KM}D * asin(sqrt(least(1D, {hav})))"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    cos_product = f"cos(radians({lat1})) * cos(radians({lat2}))"
    return km_of_angles(f"{lat2} - {lat1}", f"{lon2} - {lon1}", cos_product)
