"""D5: the exact region of a coordinate."""

from __future__ import annotations

import random

import pytest

from pluvio import fixtures as fx
from pluvio.operators import regions, stations

from conftest import SF_SMALL

RINGS = "state_name string, ring array<struct<latitude:double,longitude:double>>"


def _plain(borders, y, x):
    """Even-odd rule by loops; the smallest name of those that hold the point."""
    found = []
    for name in {n for n, _ in borders}:
        odd = False
        for n, ring in borders:
            if n == name:
                for (ya, xa), (yb, xb) in zip(ring, ring[1:] + ring[:1]):
                    (y1, x1), (y2, x2) = sorted([(ya, xa), (yb, xb)])
                    if y1 <= y < y2 and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                        odd = not odd
        if odd:
            found.append(name)
    return min(found, default=None)


BORDERS = [
    ("square", [(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0)]),
    ("square", [(4.0, 4.0), (4.0, 6.0), (6.0, 6.0), (6.0, 4.0)]),  # a lake
    ("neighbour", [(0.0, 10.0), (0.0, 20.0), (10.0, 20.0), (10.0, 10.0)]),  # shares a border
    ("star", [(20.25, 0.0), (23.0, 9.5), (28.75, 1.0), (21.0, 6.0), (27.0, 8.0)]),  # crosses itself
    ("far", [(-12.5, -3.25), (-9.0, -7.0), (-15.0, -6.75)]), ("far", [(-30.0, 30.0), (-30.5, 31.0), (-29.0, 30.5)]),
    ("over", [(2.0, 2.0), (2.0, 8.0), (3.0, 8.0), (3.0, 2.0)]),  # overlaps the square
    ("thin", [(40.0, 0.0), (40.0001, 30.0), (40.0002, 0.0)])]


@pytest.mark.parametrize("resolution, max_rows", [(1.0, 500_000), (0.7, 0), (5.0, 500_000), (50.0, 0)])
def test_matches_plain_code_on_borders_and_corners(spark, resolution, max_rows):
    rng = random.Random(3)
    points = [(y / 2, x / 2) for y in range(-4, 24) for x in range(-4, 44)]
    points += [(rng.uniform(-35, 45), rng.uniform(-10, 35)) for _ in range(1500)]
    for _, ring in BORDERS:
        points += ring + [((a + c) / 2, (b + d) / 2) for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1])]
    points += [(40.0001, 15.0), (40.00005, 0.1)]
    index = regions.region_index(spark.createDataFrame(BORDERS, RINGS), resolution)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, latitude double, longitude double")
    got = {r.id: r.state_name for r in regions.assign_region(df, index, resolution, max_rows=max_rows).collect()}
    assert got == {i: _plain(BORDERS, *p) for i, p in enumerate(points)}


def test_a_shared_border_belongs_to_one(spark):
    rings = [("a", [(0.0, 0.0), (0.1, 3.3), (7.0, 2.1), (6.9, -0.4)]), ("b", [(0.1, 3.3), (0.3, 9.0), (6.0, 8.0), (7.0, 2.1)])]
    on = [(0.1 + t / 997 * 6.9, 3.3 - t / 997 * 1.2) for t in range(1, 997)]
    index = regions.region_index(spark.createDataFrame(rings, RINGS))
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(on)], "id int, latitude double, longitude double")
    rows = regions.assign_region(points, index).collect()
    assert len(rows) == len(on) and {r.state_name for r in rows} == {"a", "b"}


def test_nulls_and_empty(spark):
    index = regions.region_index(spark.createDataFrame(
        [*BORDERS, ("none", None), ("none", []), ("none", [(None, 1.0), (float("nan"), 2.0)])], RINGS))
    points = spark.createDataFrame([(1, None, 5.0), (2, 5.0, float("nan")), (3, 1.0, 1.0), (3, 1.0, 1.0)],
                                   "id int, latitude double, longitude double")
    assert sorted((r.id, r.state_name) for r in regions.assign_region(points, index).collect()) == [
        (1, None), (2, None), (3, "square"), (3, "square")]
    empty = regions.region_index(spark.createDataFrame([], RINGS))
    assert {r.state_name for r in regions.assign_region(points, empty).collect()} == {None}


def test_plan_is_an_equi_join_without_python(spark):
    index = regions.region_index(fx.fx_region_rings(spark, SF_SMALL))
    for rows, kind in ((500_000, "BroadcastHashJoin"), (0, "Join")):
        df = regions.assign_region(fx.fx_places(spark, SF_SMALL), index, max_rows=rows)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert kind in plan and not any(w in plan for w in ("NestedLoop", "Cartesian", "Python"))


def test_enrichment_by_borders(spark):
    rings = fx.fx_region_rings(spark, SF_SMALL)
    catalog = fx.fx_full_catalog(spark, SF_SMALL)
    got = {r.id: r.state for r in stations.enrich_stations(
        catalog.select("id"), catalog, regions.region_index(rings), fx.fx_state_codes(spark, SF_SMALL), exact=True).collect()}
    borders = [(r.state_name, [(c.latitude, c.longitude) for c in r.ring]) for r in rings.collect()]
    codes = {r.state_name: r.code for r in fx.fx_state_codes(spark, SF_SMALL).collect()}
    want = {r.id: codes.get(_plain(borders, r.latitude, r.longitude)) for r in catalog.collect()}
    assert got == want and any(want.values())
