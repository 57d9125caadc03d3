"""Cell index of polygons: the exact within test from a cell's own edges.

Each polygon is cut by a grid.  A cell that its outline passes through keeps the edges
that touch the cell and one bit: whether the cell's lower left corner is inside.  A
point is then inside if the path from it, straight left to the cell's border and down to
the corner, crosses those edges an odd number of times and the corner is outside, or an
even number and the corner is inside.  Cells between two outline cells of a row are
wholly inside or wholly outside; the inside ones are kept without edges and need no test.
So an edge is stored once for each cell it touches, however wide the outline is.

* The bits of a row of cells are a running sum over the row of the edges that cross each
  cell's lower border, from the outside on.
* A cell with more than ``LEAF_EDGES`` edges is split into four, and those again, down to
  ``MAX_LEVEL``; a child takes its edges from its parent's and its bit from the parent's
  bit and edges, so splitting moves no data.
* All crossings are decided by the sign of one cross product an edge and corner of the
  path, ties as if the path ran a trifle left of and above its nominal place.  The two
  legs of a path and neighbouring cells use the same signs, so vertices and edges on
  cell borders are counted once.

Rings must be closed; the even-odd rule over all rings handles holes and several parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import on_edge, ring_segments
from ..session import cut_lineage

CELL_DEGREES = 1.0
LEAF_EDGES = 64
MAX_LEVEL = 7
# Edges are listed per cell with this margin (degrees), so floating-point rounding at a
# cell border can never drop an edge that matters; extra edges are harmless.
CLIP_MARGIN = 1e-9


def _cross(e: Column, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _left_of(e: Column, x: Column, y: Column) -> Column:
    """Side of the edge on which (x, y) lies, moved a trifle left and far less up."""
    c = _cross(e, x, y)
    tie = (e["y2"] > e["y1"]) | ((e["y2"] == e["y1"]) & (e["x2"] > e["x1"]))
    return (c > 0) | ((c == 0) & tie)


def _odd_crossings(edges: Column, px: Column, py: Column, x0: Column, y0: Column) -> Column:
    """Whether the path from (px, py) left to x0 and down to y0 crosses ``edges`` an odd
    number of times."""

    def crossed(e: Column) -> Column:
        bend = _left_of(e, x0, py)
        across = ((e["y1"] > py) != (e["y2"] > py)) & (_left_of(e, px, py) != bend)
        down = ((e["x1"] >= x0) != (e["x2"] >= x0)) & (bend != _left_of(e, x0, y0))
        return across != down

    return F.size(F.filter(edges, crossed)) % 2 == 1


def _touching(edges: Column, x0: Column, y0: Column, size: Column) -> Column:
    """The edges that may touch the box of ``size`` at (x0, y0)."""
    m = CLIP_MARGIN
    left, right, low, high = x0 - m, x0 + size + m, y0 - m, y0 + size + m

    def may(e: Column) -> Column:
        corners = [_cross(e, x, y) for x in (left, right) for y in (low, high)]
        overlap = (
            (F.greatest(e["x1"], e["x2"]) >= left) & (F.least(e["x1"], e["x2"]) <= right)
            & (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= high)
        )
        return overlap & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)

    return F.filter(edges, may)


def _edge_cells(polygons: DataFrame, cell: float) -> DataFrame:
    """(gid, cx, cy, e): every edge once for each cell that it touches."""
    m, e = CLIP_MARGIN, F.col("e")
    x1, y1, x2, y2 = (F.col(f"e.{c}") for c in ("x1", "y1", "x2", "y2"))
    edges = polygons.select("gid", F.explode(ring_segments("rings")).alias("e"))
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    rows = edges.withColumn("cy", F.explode(F.sequence(F.floor((low - m) / cell), F.floor((high + m) / cell))))

    def x_at(y: Column) -> Column:
        return x1 + (y - y1) * ((x2 - x1) / (y2 - y1))

    bottom, top = F.greatest(low, F.col("cy") * cell - m), F.least(high, (F.col("cy") + 1) * cell + m)
    flat = y1 == y2
    a, b = F.when(flat, x1).otherwise(x_at(bottom)), F.when(flat, x2).otherwise(x_at(top))
    left = F.greatest(F.least(a, b), F.least(x1, x2)) - m
    right = F.least(F.greatest(a, b), F.greatest(x1, x2)) + m
    return rows.withColumn("cx", F.explode(F.sequence(F.floor(left / cell), F.floor(right / cell)))).select("gid", "cx", "cy", e)


def _outline_cells(polygons: DataFrame, cell: float) -> DataFrame:
    """Cells of the grid with edges, and those wholly inside: (gid, level, cx, cy, inside, edges)."""
    x0, x1, y0 = F.col("cx") * cell, (F.col("cx") + 1) * cell, F.col("cy") * cell

    def crosses_bottom(e: Column) -> Column:
        return ((e["y1"] > y0) != (e["y2"] > y0)) & (_left_of(e, x0, y0) != _left_of(e, x1, y0))

    row = Window.partitionBy("gid", "cy").orderBy("cx")
    so_far = F.sum("crossings").over(row.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = (
        _edge_cells(polygons, cell).groupBy("gid", "cy", "cx").agg(F.collect_list("e").alias("edges"))
        .withColumn("crossings", F.size(F.filter("edges", crosses_bottom)))
        .withColumn("after", so_far).withColumn("next", F.lead("cx").over(row))
    )
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    own = F.struct("cx", ((F.col("after") - F.col("crossings")) % 2 == 1).alias("inside"), "edges")
    gap = F.when(
        (F.col("after") % 2 == 1) & (F.col("next") > F.col("cx") + 1),
        F.transform(F.sequence(F.col("cx") + 1, F.col("next") - 1), lambda c: F.struct(c.alias("cx"), F.lit(True).alias("inside"), none.alias("edges"))),
    )
    every = F.explode(F.concat(F.array(own), F.coalesce(gap, F.array().cast("array<struct<cx:bigint,inside:boolean,edges:array<struct<x1:double,y1:double,x2:double,y2:double>>>>"))))
    return cells.select("gid", F.lit(0).alias("level"), "cy", every.alias("c")).select("gid", "level", "c.cx", "cy", "c.inside", "c.edges")


def _split(cells: DataFrame, cell: float) -> DataFrame:
    """Cells in four; parts without edges stay only if they are inside."""
    size = F.lit(cell) / F.pow(F.lit(2.0), F.col("level"))
    x0, y0 = F.col("cx") * size, F.col("cy") * size
    edges, inside = F.col("edges"), F.col("inside")

    def part(dx: int, dy: int) -> Column:
        cx, cy, half = F.col("cx") * 2 + dx, F.col("cy") * 2 + dy, size / 2
        return F.struct(
            (F.col("level") + 1).alias("level"), cx.alias("cx"), cy.alias("cy"),
            (inside != _odd_crossings(edges, cx * half, cy * half, x0, y0)).alias("inside"), _touching(edges, cx * half, cy * half, half).alias("edges"),
        )

    parts = F.array(*[part(dx, dy) for dx in (0, 1) for dy in (0, 1)])
    out = cells.select("gid", F.explode(parts).alias("c")).select("gid", "c.*")
    return out.filter((F.size("edges") > 0) | F.col("inside"))


def polygon_index(polygons: DataFrame, cell: float = CELL_DEGREES, leaf_edges: int = LEAF_EDGES, max_level: int = MAX_LEVEL) -> DataFrame:
    """(gid, level, cx, cy, inside, n, edges) of polygons (gid, rings), with the number of
    edges.  A cell of level l is ``cell / 2^l`` wide.  Each level is written out; a level
    without crowded cells is the last."""

    def written(cells: DataFrame) -> DataFrame:
        return cut_lineage(cells.select("gid", "level", "cx", "cy", "inside", F.size("edges").alias("n"), "edges"))

    cells = written(_outline_cells(polygons, cell))
    index = cells
    for _ in range(max_level):
        crowded = cells.filter(F.col("n") > leaf_edges)
        if crowded.isEmpty():
            break
        cells = written(_split(crowded, cell))
        index = index.filter(F.col("n") <= leaf_edges).unionByName(cells)
    return index


def points_within(points: DataFrame, index: DataFrame, x: Column, y: Column, cell: float = CELL_DEGREES) -> DataFrame:
    """(columns of ``points``, gid) for every polygon of ``index`` that a point is strictly
    inside of.  A point looks in one cell of the grid, and below it only where some
    polygon's cell is split."""
    depth = (
        index.filter(F.col("level") > 0)
        .groupBy(F.expr("shiftright(cx, level)").alias("gx"), F.expr("shiftright(cy, level)").alias("gy"))
        .agg(F.max("level").alias("depth"))
    )
    at = (
        points.withColumn("px", x.cast("double")).withColumn("py", y.cast("double"))
        .withColumn("gx", F.floor(F.col("px") / cell)).withColumn("gy", F.floor(F.col("py") / cell))
        .join(depth, ["gx", "gy"], "left")
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.coalesce("depth", F.lit(0)))))
    )
    size = F.lit(cell) / F.pow(F.lit(2.0), F.col("level"))
    at = at.withColumn("cx", F.floor(F.col("px") / size)).withColumn("cy", F.floor(F.col("py") / size))
    edges, px, py = F.col("edges"), F.col("px"), F.col("py")
    inside = F.col("inside") != _odd_crossings(edges, px, py, F.col("cx") * size, F.col("cy") * size)
    tested = (F.col("n") == 0) | (inside & ~F.exists(edges, lambda e: on_edge(e, px, py)))
    return at.join(index, ["level", "cx", "cy"]).filter(tested).select(*points.columns, "gid")
