"""Nearest reference point within a radius, without comparing all pairs.

Points are put on a latitude/longitude grid whose cells are at least as wide as the radius, so
every reference in reach of a target lies in the target's cell or one of its eight neighbours,
and the search is an equi-join on the cell. Where a cell holds more references than
``leaf_size``, cells are split again and again into ``SPLIT`` x ``SPLIT`` parts. A target then
descends from cell to sub-cell and at each step keeps only sub-cells that can still hold its
nearest reference: those whose closest possible distance does not exceed the best distance
already certain. A crowded cell therefore costs each target a few sub-cells per level and not
all the references in it. The result is exact in both cases. Cells that very many targets reach are counted, and their
targets are dealt over several tasks, to each of which the cell's few references go.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.fixed import EARTH_RADIUS_KM, IMPUTE_RADIUS_KM
from epiweave.functions.geo import haversine_sql, km_of_angles
from epiweave.operators.joins import HOT_ROWS, salted_join
from epiweave.session import materialize

SPLIT = 4
MAX_DEPTH = 10
PARTS = SPLIT * SPLIT
# Bounds are compared with this slack, far above rounding noise and far below any distance
# that matters; a looser bound keeps more candidates and cannot lose one.
SLACK_KM = 1e-6


class _Grid:
    """Cell numbering for one radius, as SQL text. Bands are rows of latitude; each has its own
    cell width, since a degree of longitude shrinks towards the poles, and wraps around."""

    def __init__(self, radius_km: float):
        angle = radius_km / EARTH_RADIUS_KM
        self.sine = math.sin(min(angle, math.pi / 2))
        self.height = min(math.degrees(angle) * (1 + 1e-9), 180.0)

    def band(self, lat: str) -> str:
        return f"cast(floor({lat} / {self.height!r}D) as int)"

    @property
    def columns(self) -> str:
        """Cells around the globe in ``band``: as many as keep a cell wider than the reach of a
        target in the band or the next, and a single one close to a pole."""
        far = f"((greatest(abs(band), abs(band + 1)) + 1) * {self.height!r}D)"
        reach = f"degrees(asin(least(1D, {self.sine!r}D / cos(radians(least({far}, 89.9D)))))) * 1.000000001D"
        return f"if({far} + {self.height!r}D >= 90D, 1, greatest(1, cast(floor(360D / ({reach})) as int)))"

    @staticmethod
    def turn(lon: str) -> str:
        """Position around the globe in [0, 1)."""
        return f"pmod({lon} + 180D, 360D) / 360D"

    def column(self, lon: str) -> str:
        return f"least(cast(floor({self.turn(lon)} * n) as int), n - 1)"

    def locate(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """Add the point's own cell."""
        return (
            df.selectExpr("*", f"{self.band(lat)} as band")
            .selectExpr("*", f"{self.columns} as n")
            .selectExpr("*", f"{self.column(lon)} as slot")
        )

    def reach(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """One row per cell a point can reach: three bands, three cells in each."""
        own = self.band(lat)
        slots = f"array_distinct(transform(array(-1, 0, 1), s -> pmod({self.column(lon)} + s, n)))"
        return (
            df.selectExpr("*", f"explode(array({own} - 1, {own}, {own} + 1)) as band")
            .selectExpr("*", f"{self.columns} as n")
            .selectExpr("*", f"explode({slots}) as slot")
            .drop("n")
        )

    def sub_cell(self, lat: str, lon: str) -> str:
        """Position inside the cell after all splits, one base-``PARTS`` digit per split, so that
        a sub-cell's parent is found by integer division."""
        side = SPLIT**MAX_DEPTH
        y = f"least(cast(floor(pmod({lat} / {self.height!r}D, 1D) * {side}) as bigint), {side - 1}L)"
        x = f"least(cast(floor(pmod({self.turn(lon)} * n, 1D) * {side}) as bigint), {side - 1}L)"
        units = [(SPLIT**d, PARTS**d) for d in range(MAX_DEPTH)]
        digits = [f"(({y} div {u}) % {SPLIT} * {SPLIT} + ({x} div {u}) % {SPLIT}) * {p}L" for u, p in units]
        return " + ".join(digits)


def _cell(depth: int) -> str:
    """The sub-cell at a depth, from the deepest one."""
    return f"deepest div {PARTS ** (MAX_DEPTH - depth)}L"


def _usable(df: DataFrame, columns: dict[str, str], lat: str, lon: str) -> DataFrame:
    """Rename, and keep the rows that have a position."""
    named = df.selectExpr(
        *[f"`{src}` as {out}" for out, src in columns.items()],
        f"cast(`{lat}` as double) as lat", f"cast(`{lon}` as double) as lon",
    )
    return named.where("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)")


def _depth_needed(refs: DataFrame, leaf_size: int) -> int:
    """Fewest splits after which no sub-cell holds more than ``leaf_size`` references."""
    crowd = refs.groupBy("band", "slot").count().agg(F.max("count")).first()[0] or 0
    if crowd <= leaf_size:
        return 0
    steps = ", ".join(f"struct({d} as depth, {_cell(d)} as cell)" for d in range(1, MAX_DEPTH + 1))
    fits = (
        refs.groupBy("band", "slot", "deepest").count()
        .selectExpr("band", "slot", "count", f"inline(array({steps}))")
        .groupBy("depth", "band", "slot", "cell").agg(F.sum("count").alias("n"))
        .groupBy("depth").agg(F.max("n").alias("n"))
        .where(F.col("n") <= leaf_size).agg(F.min("depth")).first()[0]
    )
    return MAX_DEPTH if fits is None else fits


def _boxes(refs: DataFrame, depth: int) -> DataFrame:
    """Bounding box and one actual point of every non-empty cell at a depth."""
    return (
        refs.groupBy("band", "slot", F.expr(_cell(depth)).alias("cell"))
        .agg(
            F.min("ref_lat").alias("lat_lo"), F.max("ref_lat").alias("lat_hi"),
            F.min("ref_lon").alias("lon_lo"), F.max("ref_lon").alias("lon_hi"),
            F.min_by("ref_lat", "deepest").alias("one_lat"), F.min_by("ref_lon", "deepest").alias("one_lon"),
        )
        .withColumn("parent", F.expr(f"cell div {PARTS}L"))
    )


def _closest_possible() -> str:
    """Lower bound of the distance from (lat, lon) to anything in the row's box: each term of
    the haversine at its least over the box."""
    gap_lat = "greatest(0D, lat_lo - lat, lat - lat_hi)"
    edges = ", ".join(f"abs(pmod(lon - {edge} + 180D, 360D) - 180D)" for edge in ("lon_lo", "lon_hi"))
    gap_lon = f"if(lon between lon_lo and lon_hi, 0D, least({edges}))"
    cosines = "cos(radians(lat)) * least(cos(radians(lat_lo)), cos(radians(lat_hi)))"
    return km_of_angles(gap_lat, gap_lon, cosines)


def _apart(within: str) -> str:
    """Whether the latitudes alone allow a distance of ``within`` km; cheaper than the distance."""
    return f"abs(ref_lat - lat) <= ({within} + {SLACK_KM!r}D) * {math.degrees(1 / EARTH_RADIUS_KM)!r}D"


def _descend(points: DataFrame, refs: DataFrame, grid: _Grid, depth: int, max_km: float, hot_rows: int) -> DataFrame:
    """Candidate (point, leaf cell) pairs that can hold the nearest reference."""
    sure = haversine_sql("lat", "lon", "one_lat", "one_lon")
    found = grid.reach(points, "lat", "lon").selectExpr("*", "0L as cell")
    for level in range(1, depth + 1):
        found = materialize(found, "nearest-cells").withColumnRenamed("cell", "parent")
        found = (
            salted_join(found, _boxes(refs, level), ["band", "slot", "parent"], hot_rows=hot_rows)
            .selectExpr(
                "lat", "lon", "band", "slot", "cell", f"{_closest_possible()} as closest", f"{sure} as sure"
            )
            .where(f"closest <= {max_km + SLACK_KM!r}D")
            .selectExpr("*", "min(sure) over (partition by lat, lon) as best")
            .where(f"closest <= best + {SLACK_KM!r}D")
            .select("lat", "lon", "band", "slot", "cell")
        )
    return found


def nearest_within(
    targets: DataFrame,
    refs: DataFrame,
    max_km: float = IMPUTE_RADIUS_KM,
    keys: tuple[str, str] = ("departamento", "municipio"),
    lat: str = "latitud",
    lon: str = "longitud",
    leaf_size: int = 512,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Nearest reference of each target within ``max_km``; targets without one are left out.

    Output: target_dept, target_muni, ref_dept, ref_muni, dist_km. Equal distances are settled
    by the reference's names. A target name with several positions gets its overall nearest.
    """
    dept, muni = keys
    grid = _Grid(max_km)
    # Copies of one position collapse before any join, however many rows share it.
    positions = _usable(refs, {"ref_dept": dept, "ref_muni": muni}, lat, lon)
    ref_points = materialize(grid.locate(
        positions.groupBy(F.col("lat").alias("ref_lat"), F.col("lon").alias("ref_lon"))
        .agg(F.expr("min(struct(ref_dept, ref_muni))").alias("ref")),
        "ref_lat", "ref_lon",
    ).selectExpr("*", f"{grid.sub_cell('ref_lat', 'ref_lon')} as deepest"), "nearest-refs")
    target_rows = _usable(targets, {"target_dept": dept, "target_muni": muni}, lat, lon).distinct()
    points = target_rows.select("lat", "lon").distinct()

    depth = _depth_needed(ref_points, leaf_size)
    on = ["band", "slot", "cell"] if depth else ["band", "slot"]
    cells = ref_points.selectExpr("*", f"{_cell(depth)} as cell") if depth else ref_points
    reached = _descend(points, ref_points, grid, depth, max_km, hot_rows) if depth else grid.reach(points, "lat", "lon")
    candidates = materialize(reached, "nearest-cells")

    # A pair is never sorted or stored: the least distance is a number, which a hash aggregate keeps for each point, and only pairs
    # at that distance are asked for their names.
    km = haversine_sql("lat", "lon", "ref_lat", "ref_lon")
    least = (
        salted_join(candidates, cells, on, hot_rows=hot_rows)
        .where(f"{_apart(repr(float(max_km)) + 'D')} and {km} <= {float(max_km)!r}D")
        .groupBy("lat", "lon").agg(F.expr(f"min({km})").alias("least_km"))
    )
    best = (
        salted_join(candidates.join(least, ["lat", "lon"]), cells, on, hot_rows=hot_rows, counted=candidates)
        .where(f"{_apart('least_km')} and {km} <= least_km + {SLACK_KM!r}D and {km} <= {float(max_km)!r}D")
        .groupBy("lat", "lon").agg(F.expr(f"min(struct({km} as dist_km, ref))").alias("hit"))
    )
    return (
        target_rows.join(best, ["lat", "lon"])
        .groupBy("target_dept", "target_muni").agg(F.min("hit").alias("hit"))
        .select("target_dept", "target_muni", "hit.ref.ref_dept", "hit.ref.ref_muni", "hit.dist_km")
    )
