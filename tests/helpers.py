"""Small hand-made registers for unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from filingfold.sources import schemas as S
from filingfold.sources.register import LocationInputs, Register


def frame(spark: SparkSession, schema, rows: list[dict]) -> DataFrame:
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def appln(appln_id: int, **kw) -> dict:
    """A tls201 row that passes every filter of the country presets by default."""
    row = {
        "appln_id": appln_id,
        "appln_auth": "DE",
        "appln_kind": "A",
        "receiving_office": "",
        "internat_appln_id": 0,
        "nat_phase": "N",
        "reg_phase": "N",
        "earliest_filing_id": appln_id,
        "docdb_family_id": 10_000 + appln_id,
        "inpadoc_family_id": appln_id,
        "appln_filing_date": dt.date(2000, 1, 1),
        "appln_filing_year": 2000,
        "earliest_publn_date": dt.date(2001, 1, 1),
        "earliest_publn_year": 2001,
        "earliest_pat_publn_id": appln_id * 10 + 1,
        "granted": "N",
    }
    row.update(kw)
    return row


def register(
    spark: SparkSession,
    appln_rows=(),
    prior=(),
    tech_rel=(),
    person=(),
    pers_appln=(),
    publn=(),
    contn=(),
) -> Register:
    return Register(
        appln=frame(spark, S.TLS201_APPLN, list(appln_rows)),
        prior=frame(spark, S.TLS204_APPLN_PRIOR, [dict(zip(("appln_id", "prior_appln_id", "prior_appln_seq_nr"), p)) for p in prior]),
        tech_rel=frame(spark, S.TLS205_TECH_REL, [dict(zip(("appln_id", "tech_rel_appln_id"), p)) for p in tech_rel]),
        person=frame(spark, S.TLS206_PERSON, [dict(zip(("person_id", "person_ctry_code"), p)) for p in person]),
        pers_appln=frame(
            spark, S.TLS207_PERS_APPLN,
            [dict(zip(("person_id", "appln_id", "applt_seq_nr", "invt_seq_nr"), p)) for p in pers_appln],
        ),
        publn=frame(
            spark, S.TLS211_PAT_PUBLN,
            [dict(zip(("pat_publn_id", "publn_auth", "publn_nr", "publn_kind", "appln_id"), p)) for p in publn],
        ),
        contn=frame(spark, S.TLS216_APPLN_CONTN, [dict(zip(("appln_id", "parent_appln_id"), p)) for p in contn]),
    )


def locations(spark: SparkSession, addresses=(), admin=(), person_location=(), addresses_pct=(), eu=(), jp=(), kr=(), cn=()) -> LocationInputs:
    def al(rows):
        return frame(spark, S.APPLN_LOCATION, [dict(zip(("appln_id", "location_id", "app_inv"), r)) for r in rows])

    return LocationInputs(
        addresses=frame(spark, S.ADDRESSES, list(addresses)),
        admin_levels=frame(spark, S.ADMIN_LEVELS, list(admin)),
        person_location=frame(spark, S.PERSON_LOCATION, [dict(zip(("person_id", "location_id"), r)) for r in person_location]),
        addresses_pct=frame(
            spark, S.ADDRESSES_PCT, [dict(zip(("appln_id", "address_text", "relation_type_id"), r)) for r in addresses_pct]
        ),
        appln_location_eu=al(eu),
        appln_location_jp=al(jp),
        appln_location_kr=al(kr),
        appln_location_cn=al(cn),
    )


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
