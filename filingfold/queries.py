"""Registered queries: one per operator of the inventory, each (spark, sf_dir) ->
DataFrame over the driver's tables (through the fixture adapter).

Column names and order match ``oracles.oracle_queries()``.  ``lastupdate`` is left
out of compared outputs (it is a wall-clock stamp); geometry is flattened to
scalar columns, metres rounded to millimetres.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import COUNTRY_APP, COUNTRY_INV, LOCATION_APP, LOCATION_INV, Config
from .functions.labels import country_label
from .operators.bridge import bridge
from .operators.classify import excluded_applications, first_filing_applications, first_filings
from .operators.geocode import admin_of_points, attach_admin, with_geometry
from .operators.info import address_ids, country_codes, location_rows, role_rows
from .operators.pool import person_pool, pool_continual, pool_pct, pool_priority, pool_tech_rel, subsequent_pool
from .operators.select import (
    EQUIVALENT,
    LEAN,
    OTHER,
    POINT,
    copies_of,
    direct_other_codes,
    direct_other_locations,
    direct_own_codes,
    direct_own_locations,
    earliest_winner,
    expand_copies,
    locations_by_subsequent,
    other_code_rows,
    own_code_rows,
)
from .plans.country import impute_country, office_fallback
from .plans.location import GEOC_OUTPUT, flat_geometry, impute_location, location_table, with_places
from .plans.refresh import refresh_country, write_country_table
from .session import cut_lineage, ensure_checkpoint_dir
from .sources.fixtures import fixture_inputs
from .sources.layout import lay_out
from .sources.schemas import ADMIN_NAME_COLUMNS
from .sources.sinks import export_csv, read_export
from .sources.wkb import with_rings, wkb_from_rings

Query = Callable[[SparkSession, str], DataFrame]

_FLAT_GEOC = [c for c in GEOC_OUTPUT if c not in ("geom", "geom_m")]
_FLAT_GEOC.insert(_FLAT_GEOC.index("coord_source"), "geom_x")
_FLAT_GEOC.insert(_FLAT_GEOC.index("coord_source"), "geom_y")
_FLAT_GEOC.insert(_FLAT_GEOC.index("coord_source"), "geom_m_x")
_FLAT_GEOC.insert(_FLAT_GEOC.index("coord_source"), "geom_m_y")
_LOC_TABLE = (
    "appln_id", "person_id", *ADMIN_NAME_COLUMNS, "lng_exact", "lat_exact", "lng", "lat",
    "geom_x", "geom_y", "geom_m_x", "geom_m_y", "data_source", "coord_source",
)


def _exact_as_double(df: DataFrame) -> DataFrame:
    """Compared outputs carry the exact coordinates as DOUBLE (the fixture values are
    quarter degrees, exact in binary); the library keeps DECIMAL(20,15)."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in ("lat_exact", "lng_exact") else F.col(c) for c in df.columns])


# Tables that a query reads more than once are written before it, and so are the two link
# tables whose targets are long expressions, which a filter pushed into the derivation
# would compute again and again; what is read once else is derived where it is read.
_LINKS = ("tech_rel", "contn")
_FIRST_FILINGS = (*_LINKS, "pers_appln")  # persons: read by the classifier and by one join
_POOL = ("appln", "prior", *_LINKS, "pers_appln")
_BRIDGE = ("appln", "prior", *_LINKS, "publn")
_PLACES = ("addresses", "admin_levels")
_LOCATIONS = (*_PLACES, "addresses_pct")


def _reg(spark: SparkSession, sf_dir: str, stored: tuple[str, ...] = ()):
    return fixture_inputs(spark, sf_dir, stored)[0]


def _pf_apps(spark, sf_dir, cfg, stored=_POOL):
    """Register and first-filing applications, written once: the pools read them four
    times (one per pool type)."""
    reg = _reg(spark, sf_dir, stored)
    return reg, cut_lineage(first_filing_applications(first_filings(reg, cfg)))


def _person_pool(build, cfg: Config = COUNTRY_INV) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, apps = _pf_apps(spark, sf_dir, cfg)
        return person_pool(reg, build(reg, apps), apps)

    return q


def _earliest(kind: str, cfg: Config = COUNTRY_INV) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, apps = _pf_apps(spark, sf_dir, cfg)
        rows = cut_lineage(own_code_rows(reg, cfg))
        win = earliest_winner(subsequent_pool(reg, apps), kind, rows)
        return (
            win.join(rows, "subsequent_id")
            .join(apps.select("appln_id", "type"), "appln_id")
            .select("appln_id", "subsequent_id", F.col("person_id").alias("subsequent_person_id"), "ctry_code", "type", "min_date")
        )

    return q


def _country(cfg) -> Query:
    return lambda spark, sf_dir: impute_country(_reg(spark, sf_dir, _POOL), cfg, with_lastupdate=False)


def _location(cfg) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, loc = fixture_inputs(spark, sf_dir, _POOL + _LOCATIONS)
        return _exact_as_double(flat_geometry(impute_location(reg, loc, cfg)).select(*_FLAT_GEOC))

    return q


def _location_table(role: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, loc = fixture_inputs(spark, sf_dir, _LOCATIONS)
        return _exact_as_double(flat_geometry(location_table(reg, loc, role)).select(*_LOC_TABLE))

    return q


def _office_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg, apps = _pf_apps(spark, sf_dir, COUNTRY_INV)
    rows = office_fallback(reg, COUNTRY_INV)
    return rows.join(apps.select("appln_id", "type"), "appln_id").select("appln_id", "person_id", "ctry_code", "source", "type")


def _export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered CSV export, written to the shared folder and read back."""
    table = impute_country(_reg(spark, sf_dir, _POOL), COUNTRY_INV, with_lastupdate=False)
    path = f"{ensure_checkpoint_dir(spark)}/export-{uuid.uuid4().hex}"
    export_csv(table, path)
    return read_export(spark, path, table.schema)


def _impute_laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventor country table over the register in buckets."""
    return impute_country(lay_out(_reg(spark, sf_dir, _POOL)), COUNTRY_INV, with_lastupdate=False)


def _country_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The applicant country table as it is written, stamped with a given time."""
    clock = F.lit("2024-02-29 12:34:56").cast("timestamp_ntz")
    return impute_country(_reg(spark, sf_dir, _POOL), COUNTRY_APP, clock=clock)


def _refresh_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventor country table of an older edition, brought to the present one.  The
    older edition lacks some links and person rows, has other dates and person codes."""
    new = _reg(spark, sf_dir, _POOL)
    some = lambda df, n: F.pmod(F.xxhash64(*df.columns), F.lit(n)) == 0
    date = F.when(some(new.appln, 200), F.date_sub("appln_filing_date", 30)).otherwise(F.col("appln_filing_date"))
    code = F.when(some(new.person, 100), F.lit("")).otherwise(F.col("person_ctry_code"))
    old = replace(
        new, appln=new.appln.withColumn("appln_filing_date", date), person=new.person.withColumn("person_ctry_code", code),
        prior=new.prior.filter(~some(new.prior, 150)), pers_appln=new.pers_appln.filter(~some(new.pers_appln, 300)),
    )
    path = f"{ensure_checkpoint_dir(spark)}/edition-{uuid.uuid4().hex}"
    write_country_table(impute_country(old, COUNTRY_INV), path, 16)
    refresh_country(old, new, COUNTRY_INV, path, 16)
    return spark.read.parquet(path).drop("part", "lastupdate")


def _country_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _reg(spark, sf_dir).person.select(F.col("person_ctry_code").alias("ctry_code")).distinct()
    return codes.withColumn("country", country_label("ctry_code"))


def _geocode_admin(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = fixture_inputs(spark, sf_dir, _PLACES)[1]
    return attach_admin(loc.addresses, admin_of_points(loc.addresses, loc.admin_levels)).select(
        "location_id", *ADMIN_NAME_COLUMNS
    )


def _geocode_from_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``geocode_admin`` with the polygons in a database's geometry column."""
    loc = fixture_inputs(spark, sf_dir, _PLACES)[1]
    stored = cut_lineage(loc.admin_levels.withColumn("geom", wkb_from_rings("rings", 4326)).drop("rings"))
    return attach_admin(loc.addresses, admin_of_points(loc.addresses, with_rings(stored))).select("location_id", *ADMIN_NAME_COLUMNS)


def _project_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = fixture_inputs(spark, sf_dir, _PLACES)[1]
    return flat_geometry(with_geometry(loc.addresses)).select("location_id", "geom_x", "geom_y", "geom_m_x", "geom_m_y")


def _direct_own(cfg: Config = COUNTRY_INV) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg = _reg(spark, sf_dir, _FIRST_FILINGS)
        return direct_own_codes(first_filings(reg, cfg), reg, cfg)

    return q


def _direct_other(cfg: Config = COUNTRY_INV) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, apps = _pf_apps(spark, sf_dir, cfg, _FIRST_FILINGS)
        return direct_other_codes(apps, reg, cfg)

    return q


def _earliest_other_role(kind: str, cfg: Config = COUNTRY_INV) -> Query:
    """Sources 5 / 6 candidates, with the person x code multiplicity, which is applied
    to the winners' rows only."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, apps = _pf_apps(spark, sf_dir, cfg)
        rows = cut_lineage(other_code_rows(reg, cfg))
        win = earliest_winner(subsequent_pool(reg, apps), kind, rows)
        met = win.join(rows, "subsequent_id").join(copies_of(reg, cfg), "subsequent_id")
        return expand_copies(met).join(apps.select("appln_id", "type"), "appln_id").select(
            "appln_id", "subsequent_id", "ctry_code", "type", "min_date"
        )

    return q


def _pool_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location script's pool, at filing grain."""
    reg, apps = _pf_apps(spark, sf_dir, LOCATION_INV)
    return subsequent_pool(reg, apps).join(apps.select("appln_id", "patent_office", "appln_filing_year"), "appln_id").select(
        "appln_id", "subsequent_id", "patent_office", "appln_filing_year", "subsequent_date", "nb_priorities", "type"
    )


def _earliest_location(kind: str, role: str) -> Query:
    """Location sources 2, 3 (own role) and 5, 6 (other role) candidates."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, loc = fixture_inputs(spark, sf_dir, _POOL + _LOCATIONS)
        apps = cut_lineage(first_filing_applications(first_filings(reg, LOCATION_INV)))
        ids = address_ids(loc)
        rows = cut_lineage(locations_by_subsequent(role_rows(location_rows(reg, loc, ids, role), role), POINT))
        win = earliest_winner(subsequent_pool(reg, apps), kind, rows)
        out = win.join(rows, "subsequent_id").join(apps.select("appln_id", "type"), "appln_id")
        flat = _exact_as_double(flat_geometry(with_places(out, ids, loc)))
        return flat.select(
            "appln_id", "subsequent_id", *ADMIN_NAME_COLUMNS, "lat", "lng", "lat_exact", "lng_exact",
            "geom_x", "geom_y", "geom_m_x", "geom_m_y", "coord_source", "type", "min_date",
        )

    return q


def _direct_locations(own: bool) -> Query:
    """Location sources 1 and 4 (the location script's PRIORITY_FILINGS1 / 4),
    as lean rows: (appln_id, lat, lng, lat_exact, lng_exact, coord_source)."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, loc = fixture_inputs(spark, sf_dir, ("appln", *_FIRST_FILINGS, *_LOCATIONS))
        pf = cut_lineage(first_filings(reg, LOCATION_INV))
        ids = address_ids(loc)
        role = "inv" if own else "app"
        locs = cut_lineage(role_rows(location_rows(reg, loc, ids, role), role))
        rows = direct_own_locations(pf, locs, POINT) if own else direct_other_locations(first_filing_applications(pf), locs, POINT)
        return _exact_as_double(rows.join(ids.points, "point_id").select("appln_id", *LEAN))

    return q


QUERIES: dict[str, Query] = {
    "excluded_applications": lambda spark, sf_dir: excluded_applications(_reg(spark, sf_dir)),
    "first_filings_loc": lambda spark, sf_dir: first_filings(_reg(spark, sf_dir, _LINKS), LOCATION_INV),
    "first_filings_app": lambda spark, sf_dir: first_filings(_reg(spark, sf_dir, _LINKS), COUNTRY_APP),
    "first_filings_inv": lambda spark, sf_dir: first_filings(_reg(spark, sf_dir, _LINKS), COUNTRY_INV),
    "country_codes_inv": lambda spark, sf_dir: country_codes(_reg(spark, sf_dir), "inv"),
    "country_codes_app": lambda spark, sf_dir: country_codes(_reg(spark, sf_dir), "app"),
    "pool_priority": _person_pool(pool_priority),
    "pool_continual": _person_pool(pool_continual),
    "pool_tech_rel": _person_pool(pool_tech_rel),
    "pool_pct": _person_pool(pool_pct),
    "direct_own": _direct_own(),
    "direct_other": _direct_other(),
    "earliest_equivalent": _earliest(EQUIVALENT),
    "earliest_other": _earliest(OTHER),
    "office_fallback": _office_fallback,
    "impute_country_inv": _country(COUNTRY_INV),
    "impute_country_app": _country(COUNTRY_APP),
    "country_label": _country_label,
    "locations_inv": _location_table("inv"),
    "locations_app": _location_table("app"),
    "geocode_admin": _geocode_admin,
    "project_metres": _project_metres,
    "impute_location_inv": _location(LOCATION_INV),
    "impute_location_app": _location(LOCATION_APP),
    "bridge": lambda spark, sf_dir: bridge(_reg(spark, sf_dir, _BRIDGE)),
    "pool_location": _pool_location,
    "earliest_equivalent_other_role": _earliest_other_role(EQUIVALENT),
    "earliest_other_other_role": _earliest_other_role(OTHER),
    "earliest_equivalent_location": _earliest_location(EQUIVALENT, "inv"),
    "earliest_other_location": _earliest_location(OTHER, "inv"),
    "earliest_equivalent_location_other_role": _earliest_location(EQUIVALENT, "app"),
    "earliest_other_location_other_role": _earliest_location(OTHER, "app"),
    "direct_own_locations": _direct_locations(own=True),
    "direct_other_locations": _direct_locations(own=False),
    # The country operators with the applicant preset.
    "pool_priority_app": _person_pool(pool_priority, COUNTRY_APP),
    "pool_continual_app": _person_pool(pool_continual, COUNTRY_APP),
    "pool_tech_rel_app": _person_pool(pool_tech_rel, COUNTRY_APP),
    "pool_pct_app": _person_pool(pool_pct, COUNTRY_APP),
    "direct_own_app": _direct_own(COUNTRY_APP),
    "direct_other_app": _direct_other(COUNTRY_APP),
    "earliest_equivalent_app": _earliest(EQUIVALENT, COUNTRY_APP),
    "earliest_other_app": _earliest(OTHER, COUNTRY_APP),
    "earliest_equivalent_other_role_app": _earliest_other_role(EQUIVALENT, COUNTRY_APP),
    "earliest_other_other_role_app": _earliest_other_role(OTHER, COUNTRY_APP),
    "export_csv": _export_csv,
    "impute_country_laid_out": _impute_laid_out,
    "refresh_country": _refresh_country,
    "impute_country_stamped": _country_stamped,
    "geocode_from_binary": _geocode_from_binary,
}
