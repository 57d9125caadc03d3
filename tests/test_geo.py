"""Point-in-polygon (ST_Within) and the LCC metre projection."""

from __future__ import annotations

import math
import random

from filingfold.functions.geo import LCC, LCC_LAT1, LCC_LAT2, make_point, project_lcc
from filingfold.operators.cell_index import points_within, polygon_index
from filingfold.operators.geocode import admin_of_points
from filingfold.sources import schemas as S
from tests.helpers import frame, rows


def _poly(gid, name, *rings):
    return {"gid": gid, "name_0": name, "rings": [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]}


def _pts(spark, pts):
    from decimal import Decimal

    data = [{"lng_exact": None if x is None else Decimal(str(x)), "lat_exact": None if y is None else Decimal(str(y))} for x, y in pts]
    schema = S.ADDRESSES
    return frame(spark, schema, [{**d, "location_id": i} for i, d in enumerate(data)])


def test_point_in_polygon_cases(spark):
    concave = _poly(1, "U", [(0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3), (0, 0)])
    holed = _poly(2, "ring", [(10, 0), (14, 0), (14, 4), (10, 4), (10, 0)], [(11, 1), (13, 1), (13, 3), (11, 3), (11, 1)])
    multi = _poly(3, "two", [(20, 0), (21, 0), (21, 1), (20, 1), (20, 0)], [(22, 0), (23, 0), (23, 1), (22, 1), (22, 0)])
    low = _poly(4, "low", [(30, 0), (32, 0), (32, 2), (30, 2), (30, 0)])
    high = _poly(5, "high", [(31, 0), (33, 0), (33, 2), (31, 2), (31, 0)])
    admin = frame(spark, S.ADMIN_LEVELS, [concave, holed, multi, low, high])
    pts = _pts(spark, [
        (0.5, 2.5),   # arm of the U: inside
        (1.5, 2.5),   # notch of the U: outside
        (12.0, 2.0),  # hole: outside
        (10.5, 0.5),  # ring body: inside
        (22.5, 0.5),  # second part: inside
        (31.5, 1.0),  # overlap: lowest gid wins
        (3.0, 1.5),   # on an edge: not within
        (3.0, 3.0),   # on a vertex: not within
        (None, None),
    ])
    got = rows(admin_of_points(pts, admin), "lng_exact", "lat_exact", "name_0")
    got = [(float(x), float(y), n) for x, y, n in got]
    assert sorted(got) == sorted([(0.5, 2.5, "U"), (10.5, 0.5, "ring"), (22.5, 0.5, "two"), (31.5, 1.0, "low")])


def _project(spark, pts):
    df = spark.createDataFrame(pts, "lng double, lat double")
    out = df.select(project_lcc(make_point("lng", "lat")).alias("m")).collect()
    return [(r.m.x, r.m.y) if r.m is not None else None for r in out]


def test_projection_origin_and_null(spark):
    (origin, null) = _project(spark, [(10.5, 51.0), (None, None)])
    assert abs(origin[0]) < 1e-6 and abs(origin[1]) < 1e-6
    assert null is None


def test_projection_is_true_to_scale_on_standard_parallels(spark):
    a, f = 6378137.0, 1 / 298.257222101
    e2 = 2 * f - f * f
    d = 1e-4
    for lat in (LCC_LAT1, LCC_LAT2):
        (p, q) = _project(spark, [(10.5, lat), (10.5 + d, lat)])
        grid = math.hypot(q[0] - p[0], q[1] - p[1])
        phi = math.radians(lat)
        ground = a * math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2) * math.radians(d)
        assert abs(grid / ground - 1) < 1e-6
    assert 0 < LCC["n"] < 1


def test_splitting_does_not_change_the_answer(spark):
    # Many small polygons and points in one cell, split to the last level and not at all.
    polys = []
    for i in range(4):
        for j in range(4):
            x0, y0 = 5 + 0.25 * i, 5 + 0.25 * j
            polys.append(_poly(10 + 4 * i + j, f"p{i}{j}", [(x0, y0), (x0 + 0.25, y0), (x0 + 0.25, y0 + 0.25), (x0, y0 + 0.25), (x0, y0)]))
    polys.append(_poly(99, "big", [(4, 4), (7, 4), (7, 7), (4, 7), (4, 4)]))
    admin = frame(spark, S.ADMIN_LEVELS, polys)
    coords = [(5 + 0.03 * a + 0.001, 5 + 0.07 * b + 0.002) for a in range(40) for b in range(15)]
    coords += [(5.25, 5.1), (5.1, 5.5), (4.5, 6.5), (6.5, 6.999)]  # on inner edges, outside the small ones
    pts = _pts(spark, coords)
    one = rows(admin_of_points(pts, admin, leaf_edges=1), "lng_exact", "lat_exact", "name_0")
    assert one == rows(admin_of_points(pts, admin), "lng_exact", "lat_exact", "name_0")
    assert len(one) == len(coords)


def test_outline_of_many_edges(spark):
    # A circle of 10^5 edges over thousands of cells.
    n = 100_000
    ring = [(20 + 18 * math.cos(2 * math.pi * i / n), 10 + 18 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    admin = frame(spark, S.ADMIN_LEVELS, [_poly(1, "disc", [*ring, ring[0]])])
    coords = [(20.0, 10.0), (20.0, 27.99), (20.0, 28.01), (33.0, 22.0), (33.5, 22.9), (2.01, 10.0), (1.99, 10.0)]
    got = {(float(x), float(y)) for x, y in rows(admin_of_points(_pts(spark, coords), admin), "lng_exact", "lat_exact")}
    assert got == {c for c in coords if math.hypot(c[0] - 20, c[1] - 10) < 18}


def test_projection_at_control_points(spark):
    # Inverse of the public formulas (EPSG 5243): east of the axis x grows, and the
    # two parallels lie at their known meridian distances from the origin.
    (p,) = _project(spark, [(11.5, 51.0)])
    assert 69_000 < p[0] < 71_000 and 300 < p[1] < 700
    (south, north) = _project(spark, [(10.5, LCC_LAT1), (10.5, LCC_LAT2)])
    assert abs((north[1] - south[1]) - 556_470) < 700 and south[1] < 0 < north[1]


def _inside(x, y, rings):
    """Even-odd rule over all edges; false on the outline.  Exact for the dyadic
    coordinates used here."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            c = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if c == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and (c > 0) == (y2 > y1):
                odd = not odd
    return odd


def test_index_equals_even_odd_on_random_polygons(spark):
    # Vertices and points on a quarter-degree lattice: outlines run along and through
    # cell borders and corners, rings cross themselves and each other.
    rng = random.Random(8)
    at = lambda n: rng.randrange(-4 * n, 4 * n + 1) / 4
    shapes = []
    for gid in range(40):
        n = rng.choice([2, 3, 8])
        rings = []
        for _ in range(rng.choice([1, 1, 2, 3])):
            ring = [(at(n), at(n)) for _ in range(rng.randrange(3, 12))]
            rings.append([*ring, ring[0]])
        shapes.append((gid, rings))
    polys = spark.createDataFrame([(g, [[{"x": x, "y": y} for x, y in r] for r in rings]) for g, rings in shapes], "gid long, rings array<array<struct<x:double,y:double>>>")
    points = sorted({(at(9), at(9)) for _ in range(900)} | {(at(3) + rng.random() / 8, at(3) + rng.random() / 8) for _ in range(300)})
    want = {(x, y, g) for x, y in points for g, rings in shapes if _inside(x, y, rings)}
    pts = spark.createDataFrame(points, "x double, y double")
    assert len(want) > 2000
    for leaf_edges, max_level in ((64, 7), (1, 3), (4, 2)):
        index = polygon_index(polys, leaf_edges=leaf_edges, max_level=max_level)
        got = points_within(pts, index, pts.x, pts.y).collect()
        assert len(got) == len(set(map(tuple, got))) and {tuple(r) for r in got} == want, (leaf_edges, max_level)


def test_wide_outline_is_stored_once_per_touched_cell(spark):
    # 10^5 edges over 180 columns: rows and edges follow the outline, not its width
    # times its edges; cells in the middle carry no edges.
    n = 100_000
    ring = [(-90 + 180 * i / n, 40 + 0.3 * math.sin(i / 50)) for i in range(n)]
    ring = [*ring, (90.0, 10.0), (-90.0, 10.0), ring[0]]
    polys = spark.createDataFrame([(1, [[{"x": float(x), "y": float(y)} for x, y in ring]])], "gid long, rings array<array<struct<x:double,y:double>>>")
    index = polygon_index(polys)
    rows_, edges, most, plain = index.selectExpr("count(*)", "sum(size(edges))", "max(size(edges))", "sum(int(size(edges) = 0 and level = 0))").first()
    assert edges < 1.3 * n and rows_ < 0.2 * n and most <= 64 and plain > 4_000
    pts = spark.createDataFrame([(x + 0.013, y) for x in range(-95, 95) for y in (9.9, 10.5, 25.0, 39.5, 39.999, 40.2, 41.0)], "x double, y double")
    got = {tuple(r)[:2] for r in points_within(pts, index, pts.x, pts.y).collect()}
    assert got == {tuple(p) for p in pts.collect() if _inside(p.x, p.y, [ring])}
