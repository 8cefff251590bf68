import math
import random
import re

import pytest

from epiweave.operators.joins import impute_from_neighbor
from epiweave.operators.nearest import nearest_within

SCHEMA = "departamento string, municipio string, latitud double, longitud double"


def km(a, b):
    la, lb = math.radians(a[2]), math.radians(b[2])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))


def brute(targets, refs, radius):
    out = {}
    for t in targets:
        best = min(((km(t, r), r[0], r[1]) for r in refs if None not in r), default=None) if None not in t else None
        if best and best[0] <= radius and (t[:2] not in out or best < out[t[:2]]):
            out[t[:2]] = best
    return out


def check(spark, targets, refs, radius, leaf_size):
    got = nearest_within(
        spark.createDataFrame(targets, SCHEMA), spark.createDataFrame(refs, SCHEMA), radius, leaf_size=leaf_size
    ).collect()
    want = brute(targets, refs, radius)
    assert {(r.target_dept, r.target_muni) for r in got} == set(want)
    for r in got:
        dist, dept, muni = want[r.target_dept, r.target_muni]
        assert r.dist_km == pytest.approx(dist, abs=1e-6)
        if abs(dist - r.dist_km) > 0 or (r.ref_dept, r.ref_muni) != (dept, muni):
            chosen = next(x for x in refs if x[:2] == (r.ref_dept, r.ref_muni))
            target = next(x for x in targets if x[:2] == (r.target_dept, r.target_muni))
            assert km(target, chosen) == pytest.approx(dist, abs=1e-6)


def points(draw, n, name, lat, lon):
    return [(name, f"{name}{i}", draw.uniform(*lat), draw.uniform(*lon)) for i in range(n)]


@pytest.mark.parametrize("leaf_size", [512, 4])
def test_equals_all_pairs_on_spread_points(spark, leaf_size):
    draw = random.Random(1)
    check(spark, points(draw, 300, "t", (-5, 15), (-82, -65)), points(draw, 150, "r", (-5, 15), (-82, -65)), 50, leaf_size)


@pytest.mark.parametrize("leaf_size", [512, 3])
def test_equals_all_pairs_near_poles_and_date_line(spark, leaf_size):
    draw = random.Random(2)
    targets = points(draw, 60, "t", (85, 90), (-180, 180)) + points(draw, 60, "u", (-3, 3), (178, 180))
    refs = points(draw, 60, "r", (86, 90), (-180, 180)) + points(draw, 60, "s", (-3, 3), (-180, -178))
    check(spark, targets, refs, 150, leaf_size)


def test_equals_all_pairs_in_a_crowded_cell(spark):
    """Most references and targets share one cell; targets just outside the crowd descend into it."""
    draw = random.Random(3)
    refs = points(draw, 600, "r", (4.0, 4.05), (-74.05, -74.0)) + points(draw, 40, "s", (3, 6), (-76, -73))
    targets = points(draw, 150, "t", (4.0, 4.05), (-74.05, -74.0)) + points(draw, 80, "u", (3.6, 4.4), (-74.5, -73.6))
    check(spark, targets, refs, 50, 8)


def test_copies_ties_and_missing_positions(spark):
    refs = [("b", "y", 1.0, 1.0), ("a", "z", 1.0, 1.0), ("a", "x", 1.0, 1.0), ("c", "n", None, 1.0)]
    targets = [("t", "same", 1.0, 1.0)] * 3 + [("t", "far", 9.0, 9.0), ("t", "none", None, None)]
    got = nearest_within(spark.createDataFrame(targets, SCHEMA), spark.createDataFrame(refs, SCHEMA)).collect()
    assert [tuple(r) for r in got] == [("t", "same", "a", "x", 0.0)]


def test_pairs_are_not_sorted(spark):
    """Pairs meet a hash aggregate that keeps a number for each point; names are asked for at the least distance only."""
    draw = random.Random(5)
    targets, refs = points(draw, 90, "t", (4, 5), (-74, -73)), points(draw, 90, "r", (4, 5), (-74, -73))
    found = nearest_within(spark.createDataFrame(targets, SCHEMA), spark.createDataFrame(refs, SCHEMA))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[.*lat.*\], functions=\[partial_min\(", plan)
    assert "least_km" in plan


def test_imputation_falls_back_to_own_name(spark):
    fact = spark.createDataFrame([("d", "m1", 1), ("d", "m2", 1), ("d", "m3", 1), ("d", "m3", 2)], "departamento string, municipio string, semana int")
    mapping = spark.createDataFrame([("d", "m1", "d", "m2", 3.0)], "target_dept string, target_muni string, ref_dept string, ref_muni string, dist_km double")
    measures = spark.createDataFrame([("d", "m1", 1, 10.0), ("d", "m2", 1, 20.0)], "departamento string, municipio string, semana int, v double")
    got = impute_from_neighbor(fact, mapping, measures, ["semana"]).collect()
    assert sorted((r.municipio, r.semana, r.v or -1) for r in got) == [("m1", 1, 20.0), ("m2", 1, 20.0), ("m3", 1, -1), ("m3", 2, -1)]
