"""Geometry columns as databases keep them: well-known binary, plain and with SRID.

``rings_from_wkb`` reads polygons and multipolygons into the rings that
``operators.cell_index`` works on (the even-odd rule over all rings covers holes and
parts); ``wkb_from_rings``, ``wkb_from_point`` and ``point_from_wkb`` write and read the
rest.  Both byte orders are read, per geometry and nested; so are the SRID flag and
coordinates with a height or measure, which are left out.  Spark has no expression that
makes a double of eight bytes, so these are Arrow functions over whole batches; the
coordinates of a ring are one numpy view.

Defined cases: null stays null; an empty polygon or multipolygon has no rings, an empty
point (not-a-number coordinates) is null; other kinds of geometry and broken bytes are
errors.  Text columns hold the binary as hexadecimal digits, as databases dump it.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .schemas import POINT as POINT_TYPE
from .schemas import RINGS

#: The functions travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POINT, POLYGON, MULTIPOLYGON = 1, 3, 6
_Z, _M, _SRID = 0x80000000, 0x40000000, 0x20000000
XY = pa.struct([("x", pa.float64()), ("y", pa.float64())])


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at, self.order = data, 0, "<"

    def head(self) -> tuple[int, int]:
        """(kind, coordinates per point) of the geometry that begins here."""
        self.order = "<" if self.data[self.at] == 1 else ">"
        self.at += 1
        word = self.count()
        if word & _SRID:
            self.count()
        kind, thousands = (word & 0x0FFFFFFF) % 1000, (word & 0x0FFFFFFF) // 1000
        return kind, 2 + (bool(word & _Z) + bool(word & _M) or (0, 1, 1, 2)[thousands])

    def count(self) -> int:
        (n,) = struct.unpack_from(f"{self.order}I", self.data, self.at)
        self.at += 4
        return n

    def points(self, n: int, width: int) -> np.ndarray:
        flat = np.frombuffer(self.data, f"{self.order}f8", n * width, self.at)
        self.at += 8 * n * width
        return flat.reshape(n, width)[:, :2].astype(np.float64)

    def rings(self) -> list[np.ndarray]:
        kind, width = self.head()
        if kind == MULTIPOLYGON:
            return [ring for _ in range(self.count()) for ring in self.rings()]
        if kind != POLYGON:
            raise ValueError(f"a polygon or multipolygon is needed, not geometry kind {kind}")
        return [self.points(self.count(), width) for _ in range(self.count())]

    def point(self) -> np.ndarray:
        kind, width = self.head()
        if kind != POINT:
            raise ValueError(f"a point is needed, not geometry kind {kind}")
        return self.points(1, width)[0]


def _xy(points: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], fields=list(XY))


def _head(kind: int, srid: int | None) -> bytes:
    return struct.pack("<BI", 1, kind) if srid is None else struct.pack("<BII", 1, kind | _SRID, srid)


@F.arrow_udf(returnType=RINGS)
def _rings(column: pa.Array) -> pa.Array:
    of_ring, of_shape, found, null = [0], [0], [], []
    for data in column.to_pylist():
        rings = [] if data is None else _Reader(data).rings()
        found += rings
        of_ring += [of_ring[-1] + n for n in np.cumsum([len(r) for r in rings]).tolist()]
        of_shape.append(of_shape[-1] + len(rings))
        null.append(data is None)
    points = _xy(np.concatenate([*found, np.zeros((0, 2))]))
    lists = pa.ListArray.from_arrays(pa.array(of_ring, pa.int32()), points)
    return pa.ListArray.from_arrays(pa.array(of_shape, pa.int32()), lists, mask=pa.array(null, pa.bool_()))


@F.arrow_udf(returnType=POINT_TYPE)
def _point(column: pa.Array) -> pa.Array:
    points = [None if data is None else _Reader(data).point() for data in column.to_pylist()]
    return pa.array([None if p is None or np.isnan(p).any() else {"x": p[0], "y": p[1]} for p in points], XY)


def _binary(column: Column | str, text: bool) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.unhex(c) if text else c


def rings_from_wkb(column: Column | str, text: bool = False) -> Column:
    """All rings of a polygon or multipolygon; ``text``: the column holds hex digits."""
    return _rings(_binary(column, text))


def point_from_wkb(column: Column | str, text: bool = False) -> Column:
    return _point(_binary(column, text))


def wkb_from_point(column: Column | str, srid: int | None = None) -> Column:
    """A point struct as little-endian well-known binary, with its SRID if given."""

    @F.arrow_udf(returnType=BinaryType())
    def write(points: pa.Array) -> pa.Array:
        out = np.zeros(len(points), np.dtype([("head", f"S{len(_head(POINT, srid))}"), ("x", "<f8"), ("y", "<f8")]))
        null = np.array([p is None for p in points.to_pylist()], bool)
        out["x"], out["y"] = (points.field(i).fill_null(0).to_numpy(zero_copy_only=False) for i in (0, 1))
        raw, width = out.tobytes(), out.itemsize
        head = _head(POINT, srid)
        return pa.array([None if null[i] else head + raw[i * width + len(head) : (i + 1) * width] for i in range(len(out))], pa.binary())

    return write(F.col(column) if isinstance(column, str) else column)


def wkb_from_rings(column: Column | str, srid: int | None = None) -> Column:
    """Rings as one polygon: the first ring is the outline, the others are holes."""

    @F.arrow_udf(returnType=BinaryType())
    def write(shapes: pa.Array) -> pa.Array:
        out = []
        for rings in shapes.to_pylist():
            if rings is None:
                out.append(None)
                continue
            parts = [_head(POLYGON, srid), struct.pack("<I", len(rings))]
            for ring in rings:
                parts += [struct.pack("<I", len(ring)), np.array([(p["x"], p["y"]) for p in ring], "<f8").tobytes()]
            out.append(b"".join(parts))
        return pa.array(out, pa.binary())

    return write(F.col(column) if isinstance(column, str) else column)


def with_rings(df: DataFrame) -> DataFrame:
    """A polygon table with ``rings``: as it is if it has them, else from its ``geom``."""
    if "rings" in df.columns or "geom" not in df.columns:
        return df
    return df.withColumn("rings", rings_from_wkb("geom", text=df.schema["geom"].dataType.simpleString() == "string")).drop("geom")


def with_database_geometry(df: DataFrame) -> DataFrame:
    """``geom`` (degrees, 4326) and ``geom_m`` (metres, 5243) as binary with SRID, for a
    database's geometry columns."""
    return df.withColumn("geom", wkb_from_point("geom", 4326)).withColumn("geom_m", wkb_from_point("geom_m", 5243))
