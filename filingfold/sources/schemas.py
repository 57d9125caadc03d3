"""Explicit schemas of the register and location inputs (only the columns the
pipelines touch, plus the publication table, which the bridge carries whole)."""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
DATE = T.DateType()
REAL = T.FloatType()
EXACT = T.DecimalType(20, 15)
POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
RINGS = T.ArrayType(RING)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TLS201_APPLN = _schema(
    ("appln_id", ID),
    ("appln_auth", STR),
    ("appln_kind", STR),
    ("receiving_office", STR),
    ("internat_appln_id", ID),
    ("nat_phase", STR),
    ("reg_phase", STR),
    ("earliest_filing_id", ID),
    ("docdb_family_id", ID),
    ("inpadoc_family_id", ID),
    ("appln_filing_date", DATE),
    ("appln_filing_year", INT),
    ("earliest_publn_date", DATE),
    ("earliest_publn_year", INT),
    ("earliest_pat_publn_id", ID),
    ("granted", STR),
)
TLS204_APPLN_PRIOR = _schema(("appln_id", ID), ("prior_appln_id", ID), ("prior_appln_seq_nr", INT))
TLS205_TECH_REL = _schema(("appln_id", ID), ("tech_rel_appln_id", ID))
TLS206_PERSON = _schema(("person_id", ID), ("person_ctry_code", STR))
TLS207_PERS_APPLN = _schema(
    ("person_id", ID), ("appln_id", ID), ("applt_seq_nr", INT), ("invt_seq_nr", INT)
)
# The bridge selects every publication column (``t2.*``); these are the ones the
# pipelines need, any further columns of a real table are carried through.
TLS211_PAT_PUBLN = _schema(
    ("pat_publn_id", ID), ("publn_auth", STR), ("publn_nr", STR), ("publn_kind", STR), ("appln_id", ID)
)
TLS216_APPLN_CONTN = _schema(("appln_id", ID), ("parent_appln_id", ID))

ADDRESSES = _schema(
    ("location_id", ID),
    ("unformattedaddress", STR),
    ("data_source", STR),
    ("lat", REAL),
    ("lng", REAL),
    ("lat_exact", EXACT),
    ("lng_exact", EXACT),
    ("coord_source", STR),
)
ADMIN_LEVELS = _schema(
    ("gid", ID),
    ("name_0", STR), ("name_1", STR), ("name_2", STR), ("name_3", STR), ("name_4", STR), ("name_5", STR),
    ("engtype_1", STR), ("engtype_2", STR), ("engtype_3", STR), ("engtype_4", STR), ("engtype_5", STR),
    ("rings", RINGS),
)
PERSON_LOCATION = _schema(("person_id", ID), ("location_id", ID))
ADDRESSES_PCT = _schema(("appln_id", ID), ("address_text", STR), ("relation_type_id", INT))
APPLN_LOCATION = _schema(("appln_id", ID), ("location_id", ID), ("app_inv", STR))

ADMIN_NAME_COLUMNS = (
    "name_0", "name_1", "name_2", "name_3", "name_4", "name_5",
    "engtype_1", "engtype_2", "engtype_3", "engtype_4", "engtype_5",
)
# The location payload carried through the waterfall.  Names and geometry are a
# function of (lng_exact, lat_exact) and are attached after the waterfall.
LEAN_LOCATION_COLUMNS = ("lat", "lng", "lat_exact", "lng_exact", "coord_source")

REGISTER_TABLES = {
    "tls201_appln": TLS201_APPLN,
    "tls204_appln_prior": TLS204_APPLN_PRIOR,
    "tls205_tech_rel": TLS205_TECH_REL,
    "tls206_person": TLS206_PERSON,
    "tls207_pers_appln": TLS207_PERS_APPLN,
    "tls211_pat_publn": TLS211_PAT_PUBLN,
    "tls216_appln_contn": TLS216_APPLN_CONTN,
}
LOCATION_TABLES = {
    "addresses_coordinates_all": ADDRESSES,
    "admin_levels": ADMIN_LEVELS,
    "person_location_id": PERSON_LOCATION,
    "addresses_pct": ADDRESSES_PCT,
    "inventor_applicant_location_id": APPLN_LOCATION,
    "inventor_applicant_location_id_jp": APPLN_LOCATION,
    "inventor_applicant_location_id_kr": APPLN_LOCATION,
    "inventor_applicant_location_id_cn": APPLN_LOCATION,
}
