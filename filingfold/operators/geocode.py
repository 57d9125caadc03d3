"""C3 geocode enrichment: point, metre projection, administrative names.

``ST_Within(point, polygon)`` is an equi-join of distinct exact points with the cells
of ``operators.cell_index`` and an exact test on the edges of one cell; the lowest polygon
id wins where polygons overlap (the reference's ``UPDATE ... FROM`` picks an unspecified
one).  Both sides of the join come from an exchange and only ids are aggregated above it,
so AQE splits a crowded cell.  Names are joined once by polygon id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import make_point, project_lcc
from ..session import cut_lineage
from ..sources.schemas import ADMIN_NAME_COLUMNS
from .cell_index import LEAF_EDGES, points_within, polygon_index


def admin_of_points(points: DataFrame, admin_levels: DataFrame, leaf_edges: int = LEAF_EDGES) -> DataFrame:
    """(lng_exact, lat_exact, name_0..5, engtype_1..5) for every distinct point inside a
    polygon; points inside none are absent.  Written out, as several joins read it."""
    distinct = (
        points.select("lng_exact", "lat_exact")
        .filter(F.col("lng_exact").isNotNull() & F.col("lat_exact").isNotNull())
        .distinct()
    )
    index = polygon_index(admin_levels.select("gid", "rings"), leaf_edges=leaf_edges)
    hits = points_within(distinct, index, F.col("lng_exact"), F.col("lat_exact"))
    best = hits.groupBy("lng_exact", "lat_exact").agg(F.min("gid").alias("gid"))
    return cut_lineage(best.join(admin_levels.select("gid", *ADMIN_NAME_COLUMNS), "gid").drop("gid"))


def attach_admin(df: DataFrame, admin_points: DataFrame) -> DataFrame:
    """Left join names on the exact point; unmatched rows keep NULL.  Rows without a
    point never match and stay out of the join, where they would all share a key."""
    located = F.col("lng_exact").isNotNull() & F.col("lat_exact").isNotNull()
    named = df.filter(located).join(admin_points, ["lng_exact", "lat_exact"], "left")
    nameless = df.filter(~located)
    for c in ADMIN_NAME_COLUMNS:
        nameless = nameless.withColumn(c, F.lit(None).cast("string"))
    return named.unionByName(nameless)


def with_geometry(df: DataFrame) -> DataFrame:
    """``geom`` from the exact coordinates and ``geom_m`` in metres."""
    return df.withColumn("geom", make_point("lng_exact", "lat_exact")).withColumn("geom_m", project_lcc("geom"))


def geocode_addresses(addresses: DataFrame, admin_levels: DataFrame) -> DataFrame:
    """The enriched address table: every address with names and geometry."""
    return with_geometry(attach_admin(addresses, admin_of_points(addresses, admin_levels)))
