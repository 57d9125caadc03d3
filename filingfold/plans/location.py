"""impute_location(role): first filings -> geocoded location of their inventors
(GEOC_INV) or applicants (GEOC_APP)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LOCATION_APP, LOCATION_INV, Config
from ..operators.classify import first_filing_applications, first_filings
from ..operators.geocode import admin_of_points, attach_admin, with_geometry
from ..operators.info import AddressIds, address_ids, location_rows, locations, role_rows
from ..operators.pool import subsequent_pool
from ..operators.select import (
    POINT,
    direct_other_locations,
    direct_own_locations,
    locations_by_subsequent,
)
from ..operators.waterfall import Candidates, assemble, fill, still_open
from ..session import cut_lineage
from ..sources.register import LocationInputs, Register
from ..sources.schemas import ADMIN_NAME_COLUMNS

GEOC_OUTPUT = (
    "appln_id", "patent_office", "priority_date", "priority_year", *ADMIN_NAME_COLUMNS,
    "lat", "lng", "lat_exact", "lng_exact", "geom", "geom_m", "coord_source", "source", "type",
)


def enrich_locations(rows: DataFrame, loc: LocationInputs) -> DataFrame:
    """Attach administrative names (point in polygon) and geometry to lean rows.  The
    names are those of the address table's distinct points, a stage of its own: every
    row's point comes from there, and ``rows`` is read once."""
    return with_geometry(attach_admin(rows, admin_of_points(loc.addresses, loc.admin_levels)))


def with_places(rows: DataFrame, ids: AddressIds, loc: LocationInputs) -> DataFrame:
    """Rows by ``point_id`` with coordinates, names and geometry: a table of the distinct
    points, joined last."""
    places = cut_lineage(attach_admin(ids.points, admin_of_points(ids.points, loc.admin_levels)))
    return with_geometry(rows.join(places, "point_id"))


def location_table(reg: Register, loc: LocationInputs, role: str) -> DataFrame:
    """C4 with names and geometry, as the reference's addresses_coordinates_all_{inv,app}."""
    return enrich_locations(locations(reg, loc, role), loc)


def impute_location(reg: Register, loc: LocationInputs, cfg: Config) -> DataFrame:
    # Materialise the frames several branches read (see plans.country).
    pf = cut_lineage(first_filings(reg, cfg))
    pf_apps = cut_lineage(first_filing_applications(pf))
    ids = address_ids(loc)
    rows = cut_lineage(location_rows(reg, loc, ids))  # both roles, one pass over the inputs
    own = role_rows(rows, cfg.role)
    other = role_rows(rows, cfg.other_role)
    cands = Candidates(
        own_direct=cut_lineage(direct_own_locations(pf, own, POINT)),
        own_by_subsequent=locations_by_subsequent(own, POINT),
        other_direct=direct_other_locations(pf_apps, other, POINT),
        other_by_subsequent=locations_by_subsequent(other, POINT),
    )
    filled = fill(cut_lineage(subsequent_pool(reg, still_open(pf_apps, cands.own_direct))), cands, POINT)
    return with_places(assemble(filled, pf_apps), ids, loc).select(*GEOC_OUTPUT)


def impute_location_inv(reg: Register, loc: LocationInputs) -> DataFrame:
    return impute_location(reg, loc, LOCATION_INV)


def impute_location_app(reg: Register, loc: LocationInputs) -> DataFrame:
    return impute_location(reg, loc, LOCATION_APP)


def flat_geometry(df: DataFrame, decimals: int = 3) -> DataFrame:
    """Geometry as scalar columns (for comparison and CSV): geom_x/y in degrees,
    geom_m_x/y in metres rounded to ``decimals``."""
    return (
        df.withColumn("geom_x", F.col("geom.x"))
        .withColumn("geom_y", F.col("geom.y"))
        .withColumn("geom_m_x", F.round(F.col("geom_m.x"), decimals))
        .withColumn("geom_m_y", F.round(F.col("geom_m.y"), decimals))
        .drop("geom", "geom_m")
    )
