"""Register and location inputs as DataFrames.

``read_register`` / ``read_locations`` read a directory of parquet tables (one
sub-directory per table, named as in the register) with explicit schemas, so that
the scan reads only the columns the pipelines project and filters reach the
parquet reader.  ``sources.fixtures`` builds the same dataclasses from the
driver's star schema for tests.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S
from .wkb import with_rings

if TYPE_CHECKING:
    from .layout import Layout


@dataclass(frozen=True)
class Register:
    appln: DataFrame  # tls201_appln
    prior: DataFrame  # tls204_appln_prior
    tech_rel: DataFrame  # tls205_tech_rel
    person: DataFrame  # tls206_person
    pers_appln: DataFrame  # tls207_pers_appln
    publn: DataFrame  # tls211_pat_publn
    contn: DataFrame  # tls216_appln_contn

    layout = None  # a table for each field; bucketed copies are those of LaidOutRegister


@dataclass(frozen=True)
class LaidOutRegister(Register):
    """A register with bucketed copies (``sources.layout``)."""

    layout: Layout | None = None


@dataclass(frozen=True)
class LocationInputs:
    addresses: DataFrame  # addresses_coordinates_all (lean: no names, no geometry)
    admin_levels: DataFrame  # polygons with names
    person_location: DataFrame  # person_location_id
    addresses_pct: DataFrame  # WIPO addresses joined on free text
    appln_location_eu: DataFrame  # inventor_applicant_location_id
    appln_location_jp: DataFrame
    appln_location_kr: DataFrame
    appln_location_cn: DataFrame


def _read(spark: SparkSession, base: str, name: str, schema, exact: bool = False) -> DataFrame:
    """Read one table.  ``exact``: the files have exactly ``schema`` (no footer
    inference); otherwise the declared columns are cast and any extra column is
    kept (the bridge carries every publication column).  Polygons may come as a database's
    geometry column ``geom`` (``sources.wkb``) in place of ``rings``."""
    path = f"{base.rstrip('/')}/{name}"
    if exact:
        return spark.read.schema(schema).parquet(path)
    df = with_rings(spark.read.parquet(path)) if name == "admin_levels" else spark.read.parquet(path)
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *extra)


def read_register(spark: SparkSession, base: str, exact: bool = False) -> Register:
    r = {name: _read(spark, base, name, schema, exact) for name, schema in S.REGISTER_TABLES.items()}
    return Register(
        appln=r["tls201_appln"],
        prior=r["tls204_appln_prior"],
        tech_rel=r["tls205_tech_rel"],
        person=r["tls206_person"],
        pers_appln=r["tls207_pers_appln"],
        publn=r["tls211_pat_publn"],
        contn=r["tls216_appln_contn"],
    )


def read_locations(spark: SparkSession, base: str, exact: bool = False) -> LocationInputs:
    r = {name: _read(spark, base, name, schema, exact) for name, schema in S.LOCATION_TABLES.items()}
    return LocationInputs(
        addresses=r["addresses_coordinates_all"],
        admin_levels=r["admin_levels"],
        person_location=r["person_location_id"],
        addresses_pct=r["addresses_pct"],
        appln_location_eu=r["inventor_applicant_location_id"],
        appln_location_jp=r["inventor_applicant_location_id_jp"],
        appln_location_kr=r["inventor_applicant_location_id_kr"],
        appln_location_cn=r["inventor_applicant_location_id_cn"],
    )
