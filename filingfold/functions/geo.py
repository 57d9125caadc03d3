"""Geometry as native column expressions.

Points are ``struct<x: double, y: double>`` (x = longitude, y = latitude).
Polygons are ``array<array<struct<x,y>>>``: a list of closed rings; the even-odd
rule over all rings handles holes and multi-part features.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_point(x: Column | str, y: Column | str) -> Column:
    """``ST_SetSRID(ST_MakePoint(x, y), 4326)``: NULL when either coordinate is NULL."""
    xc = (F.col(x) if isinstance(x, str) else x).cast("double")
    yc = (F.col(y) if isinstance(y, str) else y).cast("double")
    return F.when(xc.isNotNull() & yc.isNotNull(), F.struct(xc.alias("x"), yc.alias("y")))


# Lambert conformal conic, two standard parallels, on the GRS80 ellipsoid:
# the "LCC Germany" projected system (EPSG 5243), easting/northing in metres.
LCC_A = 6378137.0
LCC_INV_F = 298.257222101
LCC_LAT0 = 51.0
LCC_LON0 = 10.5
LCC_LAT1 = 48.0 + 40.0 / 60.0
LCC_LAT2 = 53.0 + 40.0 / 60.0
LCC_X0 = 0.0
LCC_Y0 = 0.0


def _lcc_constants() -> dict[str, float]:
    f = 1.0 / LCC_INV_F
    e = math.sqrt(2 * f - f * f)

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi: float) -> float:
        s = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    p0, p1, p2 = (math.radians(v) for v in (LCC_LAT0, LCC_LAT1, LCC_LAT2))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    return {"e": e, "n": n, "aF": LCC_A * big_f, "r0": LCC_A * big_f * t(p0) ** n, "lon0": math.radians(LCC_LON0)}


LCC = _lcc_constants()


def project_lcc(point: Column | str) -> Column:
    """``ST_Transform(point, 5243)`` in closed form; NULL for a NULL point or the south pole."""
    p = F.col(point) if isinstance(point, str) else point
    e, n, a_f, r0, lon0 = LCC["e"], LCC["n"], LCC["aF"], LCC["r0"], LCC["lon0"]
    phi = F.radians(p["y"])
    lam = F.radians(p["x"])
    es = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2))
    r = F.lit(a_f) * F.pow(t, F.lit(n))
    dlam = F.pmod(lam - F.lit(lon0) + F.lit(math.pi), F.lit(2 * math.pi)) - F.lit(math.pi)
    theta = F.lit(n) * dlam
    east = F.lit(LCC_X0) + r * F.sin(theta)
    north = F.lit(LCC_Y0) + F.lit(r0) - r * F.cos(theta)
    return F.when(p.isNotNull() & (p["y"] > -90.0), F.struct(east.alias("x"), north.alias("y")))


def ring_segments(rings: Column | str) -> Column:
    """All edges of all rings as ``array<struct<x1,y1,x2,y2>>`` (computed once per polygon)."""
    rs = F.col(rings) if isinstance(rings, str) else rings

    def edges(ring: Column) -> Column:
        idx = F.sequence(F.lit(0), F.size(ring) - 2)
        seg = F.transform(
            idx,
            lambda i: F.struct(
                ring[i]["x"].alias("x1"),
                ring[i]["y"].alias("y1"),
                ring[i + 1]["x"].alias("x2"),
                ring[i + 1]["y"].alias("y2"),
            ),
        )
        return F.when(F.size(ring) >= 2, seg).otherwise(F.array().cast(seg_type()))

    return F.flatten(F.transform(rs, edges))


def seg_type() -> str:
    return "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def on_edge(s: Column, px: Column, py: Column) -> Column:
    """Whether the point lies on the edge, ends included."""
    return (
        ((s["x2"] - s["x1"]) * (py - s["y1"]) - (px - s["x1"]) * (s["y2"] - s["y1"]) == 0)
        & (px >= F.least(s["x1"], s["x2"]))
        & (px <= F.greatest(s["x1"], s["x2"]))
        & (py >= F.least(s["y1"], s["y2"]))
        & (py <= F.greatest(s["y1"], s["y2"]))
    )


def point_within(px: Column, py: Column, segments: Column) -> Column:
    """``ST_Within(point, polygon)``: strictly inside by the even-odd rule, false on
    any edge or vertex (the boundary is not "within").  Reads all edges of the polygon;
    ``operators.cell_index`` gives the same answer from those of one cell."""

    def crosses(s: Column) -> Column:
        straddles = (s["y1"] > py) != (s["y2"] > py)
        c = (s["x2"] - s["x1"]) * (py - s["y1"]) - (px - s["x1"]) * (s["y2"] - s["y1"])
        right_of_point = F.when(s["y2"] > s["y1"], c > 0).otherwise(c < 0)
        return straddles & right_of_point

    n_cross = F.size(F.filter(segments, crosses))
    return (n_cross % 2 == 1) & ~F.exists(segments, lambda s: on_edge(s, px, py))
