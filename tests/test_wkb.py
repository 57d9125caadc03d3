"""Well-known binary: hand-made bytes in both orders, with SRID, holes and parts."""

from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from filingfold.operators.geocode import admin_of_points
from filingfold.sources import schemas as S
from filingfold.sources.register import read_locations
from filingfold.sources.wkb import point_from_wkb, rings_from_wkb, with_database_geometry, wkb_from_point, wkb_from_rings
from tests.helpers import frame

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (1.0, 1.0)]
FAR = [(10.0, 10.0), (11.0, 10.0), (11.0, 11.5), (10.0, 10.0)]


def polygon(rings, order="<", srid=None, extra=0, iso=False):
    kind = 3 + (1000 * extra if iso else 0)
    flags = (0x20000000 if srid is not None else 0) | (0x80000000 if extra and not iso else 0)
    out = struct.pack(f"{order}BI", order == "<", kind | flags) + (struct.pack(f"{order}I", srid) if srid is not None else b"")
    out += struct.pack(f"{order}I", len(rings))
    for ring in rings:
        out += struct.pack(f"{order}I", len(ring)) + b"".join(struct.pack(f"{order}{2 + extra}d", *p, *[9.0] * extra) for p in ring)
    return out


def multi(parts, order="<", srid=None):
    head = struct.pack(f"{order}BI", order == "<", 6 | (0x20000000 if srid is not None else 0))
    return head + (struct.pack(f"{order}I", srid) if srid is not None else b"") + struct.pack(f"{order}I", len(parts)) + b"".join(parts)


def read(spark, values, function=rings_from_wkb):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, g binary").select("i", function("g").alias("r")).collect()
    return [r.r for r in sorted(rows)]


def plain(rings):
    return None if rings is None else [[(p.x, p.y) for p in ring] for ring in rings]


def test_polygons(spark):
    values = [
        polygon([SQUARE, HOLE]), polygon([SQUARE, HOLE], ">"), polygon([SQUARE], "<", 4326), polygon([SQUARE], ">", 4326),
        multi([polygon([SQUARE, HOLE], ">"), polygon([FAR], "<")], ">", 4326), polygon([SQUARE], extra=1), polygon([SQUARE], extra=1, iso=True),
        None, polygon([]), multi([]),
    ]
    got = [plain(r) for r in read(spark, values)]
    assert got == [[SQUARE, HOLE], [SQUARE, HOLE], [SQUARE], [SQUARE], [SQUARE, HOLE, FAR], [SQUARE], [SQUARE], None, [], []]


def test_points(spark):
    values = [struct.pack("<BIdd", 1, 1, 1.5, -2.25), struct.pack(">BIIdd", 0, 0x20000001, 4326, 1.5, -2.25), None, struct.pack("<BIdd", 1, 1, *[float("nan")] * 2)]
    got = [p and (p.x, p.y) for p in read(spark, values, point_from_wkb)]
    assert got == [(1.5, -2.25), (1.5, -2.25), None, None]


def test_written_bytes_are_as_by_hand_and_read_back(spark):
    point = "struct<x:double,y:double>"
    df = spark.createDataFrame([({"x": 1.5, "y": -2.25}, [[{"x": x, "y": y} for x, y in r] for r in (SQUARE, HOLE)]), (None, None)], f"p {point}, r array<array<{point}>>")
    a, b = df.select(wkb_from_point("p").alias("p"), wkb_from_point("p", 4326).alias("ps"), wkb_from_rings("r", 4326).alias("r")).collect()
    assert bytes(a.p) == struct.pack("<BIdd", 1, 1, 1.5, -2.25)
    assert bytes(a.ps) == struct.pack("<BIIdd", 1, 0x20000001, 4326, 1.5, -2.25)
    assert bytes(a.r) == polygon([SQUARE, HOLE], srid=4326)
    assert (b.p, b.ps, b.r) == (None, None, None)
    both = df.withColumnRenamed("p", "geom").withColumn("geom_m", F.col("geom"))
    assert bytes(with_database_geometry(both).first().geom_m)[5:9] == struct.pack("<I", 5243)


def test_other_kinds_and_broken_bytes_are_errors(spark):
    for bad in (struct.pack("<BII", 1, 2, 0), polygon([SQUARE])[:40], b""):
        with pytest.raises(Exception, match="needed|buffer|range"):
            read(spark, [bad])


@pytest.mark.parametrize("text", [False, True])
def test_admin_levels_from_a_database_column(spark, tmp_path, text):
    shapes = [(1, "holed", multi([polygon([SQUARE, HOLE], ">"), polygon([FAR])], "<", 4326))]
    admin = spark.createDataFrame(shapes, "gid long, name_0 string, geom binary")
    for f in S.ADMIN_LEVELS.fields:
        if f.name not in (*admin.columns, "rings"):
            admin = admin.withColumn(f.name, F.lit(None).cast(f.dataType))
    if text:
        admin = admin.withColumn("geom", F.hex("geom"))
    for name, schema in S.LOCATION_TABLES.items():
        (admin if name == "admin_levels" else spark.createDataFrame([], schema)).write.parquet(f"{tmp_path}/{name}")
    loc = read_locations(spark, str(tmp_path))
    assert loc.admin_levels.columns == S.ADMIN_LEVELS.fieldNames()
    pts = [{"location_id": i, "lng_exact": x, "lat_exact": y} for i, (x, y) in enumerate([(3, 3), (1.25, 1.75), (10.75, 10.5), (20, 1)])]
    from decimal import Decimal

    addresses = frame(spark, S.ADDRESSES, [{**p, "lng_exact": Decimal(str(p["lng_exact"])), "lat_exact": Decimal(str(p["lat_exact"]))} for p in pts])
    found = {(float(r.lng_exact), float(r.lat_exact)) for r in admin_of_points(addresses, loc.admin_levels).collect()}
    assert found == {(3.0, 3.0), (10.75, 10.5)}
