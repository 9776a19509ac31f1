"""Zones by containment against a plain ray test over whole polygons."""

import math
import random

import pytest

from eventfeat.operators import zones as Z


def plain(x, y, rings):
    """Crossings to the east over all edges of a zone, rings in running longitudes."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def vertex_rows(zones):
    return [(z, f"zone {z}", k, i, float(y), (x + 180) % 360 - 180.0) for z, rings in zones.items() for k, ring in enumerate(rings) for i, (x, y) in enumerate(ring)]


def star(rng, cx, cy, size, n):
    return [(cx + size * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), cy + size * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n))
            for k in range(n)]


def found(spark, zones, points, cell):
    v = spark.createDataFrame(vertex_rows(zones), "zone_id int, zone string, ring int, seq int, lat double, lon double")
    p = spark.createDataFrame([(k, float(y), float(x)) for k, (x, y) in enumerate(points)], "id int, plat double, plon double")
    rows = Z.zone_containing(p, v, "plat", "plon", zone_cols=["zone"], cell_deg=cell).collect()
    assert len(rows) == len(points) and all(r.zone == (None if r.zone_id is None else f"zone {r.zone_id}") for r in rows)
    return {r.id: r.zone_id for r in rows}


def expected(zones, x, y):
    x = (x + 180) % 360 - 180
    return min((z for z, rings in zones.items() if any(plain(x + t, y, rings) for t in (-360, 0, 360))), default=None)


@pytest.mark.parametrize("cell", [0.5, 5.0, 45.0])
def test_random_polygons_with_holes_and_the_date_line(spark, cell):
    rng = random.Random(11)
    zones = {}
    for z, (cx, cy) in enumerate([(0, 0), (179.5, 10), (-178, -30), (60, 60), (62, 58), (-100, 45)]):
        outer = star(rng, cx, cy, 9, 14)
        zones[z] = [outer, star(rng, cx, cy, 1.5, 6)]  # the second ring is a hole
    zones[9] = [[(20, 20), (30, 20), (30, 30), (20, 30)], [(22, 22), (28, 22), (28, 28), (22, 28)], [(24, 24), (26, 24), (26, 26), (24, 26)]]
    points = [(rng.choice([0, 179.5, -178, 61, -100, 25]) + rng.uniform(-11, 11), rng.choice([0, 10, -30, 59, 45, 25]) + rng.uniform(-11, 11))
              for _ in range(1500)]
    got = found(spark, zones, points, cell)
    want = {k: expected(zones, x, y) for k, (x, y) in enumerate(points)}
    assert got == want and len(set(want.values())) > 6


def test_borders_belong_to_one_neighbour(spark):
    zones = {1: [[(0, 0), (4, 0), (4, 4), (0, 4)]], 2: [[(4, 0), (8, 0), (8, 4), (4, 4)]], 3: [[(0, 4), (8, 4), (8, 8), (0, 8)]]}
    points = [(x / 2, y / 2) for x in range(-1, 18) for y in range(-1, 18)]
    for cell in (1.0, 4.0):
        got = found(spark, zones, points, cell)
        for k, (x, y) in enumerate(points):
            here = [z for z in zones if plain(x, y, zones[z])]
            assert len(here) <= 1 and got[k] == (here[0] if here else None), (x, y)


def test_seam_ring_polar_cap_and_bad_rows(spark):
    zones = {1: [[(-180, -90), (180, -90), (180, -60), (-180, -60)]]}  # drawn from -180 to 180
    v = spark.createDataFrame([(1, "cap", 0, i, float(y), float(x)) for i, (x, y) in enumerate(zones[1][0])] + [(1, "cap", 0, 9, None, 5.0)],
                              "zone_id int, zone string, ring int, seq int, lat double, lon double")
    p = spark.createDataFrame([(1, -75.0, 10.0), (2, -75.0, 179.99), (3, -75.0, -180.0), (4, 0.0, 0.0), (5, None, 3.0), (6, -70.0, float("nan")),
                               (7, -95.0, 0.0), (8, -75.0, 370.0), (8, -75.0, 370.0)], "id int, lat double, lon double")
    got = sorted((r.id, r.zone_id) for r in Z.zone_containing(p, v, "lat", "lon").collect())
    assert got == [(1, 1), (2, 1), (3, 1), (4, None), (5, None), (6, None), (7, None), (8, 1), (8, 1)]


def test_whole_tiles_carry_no_edges(spark):
    v = spark.createDataFrame(vertex_rows({1: [[(0.5, 0.5), (9.5, 0.5), (9.5, 9.5), (0.5, 9.5)]]}),
                              "zone_id int, zone string, ring int, seq int, lat double, lon double")
    tiles = Z.zone_tiles(Z.zone_edges(v), 1.0).collect()
    assert len(tiles) == 100 and sum(not t.edges and t.inside for t in tiles) == 64


def test_empty_tables(spark):
    v = spark.createDataFrame([], "zone_id int, ring int, seq int, lat double, lon double")
    p = spark.createDataFrame([(1, 2.0, 3.0)], "id int, plat double, plon double")
    assert [tuple(r) for r in Z.zone_containing(p, v, "plat", "plon").collect()] == [(1, 2.0, 3.0, None)]
    assert Z.zone_containing(p.limit(0), v, "plat", "plon").count() == 0
