"""Hand cases for the reference's quirks and NULL rules (§1.4)."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from filingfold.config import COUNTRY_APP, COUNTRY_INV, LOCATION_INV
from filingfold.operators.bridge import bridge
from filingfold.operators.classify import first_filings
from filingfold.operators.info import locations
from filingfold.plans.country import impute_country
from tests.helpers import appln, locations as make_locations, register, rows


def _pct_register(spark):
    return register(
        spark,
        appln_rows=[appln(1, appln_kind="W", appln_auth="WO", receiving_office="DE")],
        pers_appln=[(100, 1, 0, 1)],
        publn=[(11, "WO", "1", "A1", 1)],
    )


def test_q1_pct_person_is_null_in_location_preset(spark):
    reg = _pct_register(spark)
    assert rows(first_filings(reg, LOCATION_INV), "appln_id", "person_id", "type") == [(1, None, "pct")]
    corrected = replace(LOCATION_INV, pct_person="corrected")
    assert rows(first_filings(reg, corrected), "appln_id", "person_id", "type") == [(1, 100, "pct")]


def test_q2_data_source_test_guards_only_first_relation(spark):
    reg = register(spark, appln_rows=[appln(1)])
    addr = [
        {"location_id": 1, "unformattedaddress": "a1", "data_source": "JP", "lat": 1.0, "lng": 1.0, "coord_source": "API"},
        {"location_id": 2, "unformattedaddress": "a2", "data_source": "JP", "lat": 2.0, "lng": 2.0, "coord_source": "API"},
        {"location_id": 3, "unformattedaddress": "a3", "data_source": "PCT", "lat": 3.0, "lng": 3.0, "coord_source": "API"},
    ]
    loc = make_locations(spark, addresses=addr, addresses_pct=[(1, "a1", 7), (1, "a2", 4), (1, "a3", 4)])
    got = rows(locations(reg, loc, "inv"), "appln_id", "person_id", "lat")
    assert got == [(1, 0, 1.0), (1, 0, 3.0)]


def _fanout_register(spark):
    return register(
        spark,
        appln_rows=[appln(1, docdb_family_id=7), appln(2, docdb_family_id=7, appln_filing_date=dt.date(2001, 1, 1))],
        prior=[(2, 1, 1)],
        pers_appln=[(100, 1, 0, 1), (101, 1, 1, 0), (200, 2, 0, 1), (300, 2, 1, 0), (301, 2, 2, 0)],
        person=[(100, ""), (101, None), (200, ""), (300, "FR"), (301, "US")],
    )


def test_q3_cross_role_fan_out_is_reproduced(spark):
    reg = _fanout_register(spark)
    out = impute_country(reg, COUNTRY_INV, with_lastupdate=False).filter(F.col("appln_id") == 1)
    assert rows(out, "person_id", "ctry_code", "source") == [(0, "FR", 5), (0, "FR", 5), (0, "US", 5), (0, "US", 5)]
    deduped = impute_country(reg, replace(COUNTRY_INV, dedupe_cross_role=True), with_lastupdate=False)
    assert rows(deduped.filter(F.col("appln_id") == 1), "ctry_code", "source") == [("FR", 5), ("US", 5)]


def test_q13_wo_office_is_barred_from_office_fallback(spark):
    reg = register(
        spark,
        appln_rows=[appln(1, appln_kind="W", appln_auth="WO", receiving_office="DE"), appln(2)],
        pers_appln=[(100, 1, 1, 1), (101, 2, 1, 1), (102, 2, 2, 2)],
        person=[(100, ""), (101, ""), (102, None)],
    )
    out = impute_country(reg, COUNTRY_APP, with_lastupdate=False)
    assert rows(out, "appln_id", "person_id", "ctry_code", "source", "country") == [
        (2, 0, "DE", 7, "Germany"),
        (2, 0, "DE", 7, "Germany"),
    ]


def test_null_kind_is_never_a_first_filing(spark):
    reg = register(spark, appln_rows=[appln(1, appln_kind=None), appln(2)], pers_appln=[(1, 1, 1, 1), (2, 2, 1, 1)])
    assert rows(first_filings(reg, COUNTRY_APP), "appln_id") == [(2,)]


def test_empty_code_is_missing_and_null_date_never_wins(spark):
    reg = register(
        spark,
        appln_rows=[
            appln(1, docdb_family_id=7),
            appln(2, docdb_family_id=7, appln_filing_date=None),
            appln(3, docdb_family_id=7, appln_filing_date=dt.date(2002, 1, 1)),
            appln(4, docdb_family_id=7, appln_filing_date=dt.date(2002, 1, 1)),
        ],
        prior=[(2, 1, 1), (3, 1, 1), (4, 1, 1)],
        pers_appln=[(100, 1, 0, 1), (200, 2, 0, 1), (300, 3, 0, 1), (301, 3, 0, 2), (400, 4, 0, 1)],
        person=[(100, ""), (200, "FR"), (300, "IT"), (301, "ES"), (400, "GB")],
    )
    out = impute_country(reg, COUNTRY_INV, with_lastupdate=False).filter(F.col("appln_id") == 1)
    # 2 has no date, 3 and 4 tie on the date: 3 (lowest id) wins with all its rows.
    assert rows(out, "person_id", "ctry_code", "source") == [(300, "IT", 2), (301, "ES", 2)]


def test_q11_bridge_pair_under_two_types(spark):
    reg = register(
        spark,
        appln_rows=[appln(1, docdb_family_id=7), appln(2, docdb_family_id=7)],
        contn=[(2, 1)],
        tech_rel=[(2, 1)],
        publn=[(11, "DE", "1", "A1", 1), (21, "DE", "2", "A1", 2)],
    )
    got = rows(bridge(reg), "prior_appln_id", "appln_id", "type")
    assert got == [(1, 1, "CONTINUAL"), (1, 2, "CONTINUAL"), (1, 2, "TECH_REL")]


def test_source_6_other_role_of_other_subsequent_filing(spark):
    # 2 claims two priorities (nb = 2: an "other" subsequent filing, not an
    # equivalent); nobody has an inventor code, 2's applicant has one.
    reg = register(
        spark,
        appln_rows=[appln(1, docdb_family_id=7), appln(2, docdb_family_id=7), appln(3, docdb_family_id=7)],
        prior=[(2, 1, 1), (2, 3, 2)],
        pers_appln=[(100, 1, 0, 1), (200, 2, 0, 1), (300, 2, 1, 0)],
        person=[(100, None), (200, ""), (300, "FR")],
    )
    out = impute_country(reg, COUNTRY_INV, with_lastupdate=False).filter(F.col("appln_id") == 1)
    assert rows(out, "person_id", "ctry_code", "source", "country") == [(0, "FR", 6, "France")]
