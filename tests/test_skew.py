"""With one key on half of the rows, AQE splits the hot partition of each join."""

from __future__ import annotations

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from filingfold.config import COUNTRY_INV
from filingfold.operators.geocode import attach_admin
from filingfold.operators.info import country_codes, location_rows
from filingfold.operators.pool import person_pool
from filingfold.operators.select import own_code_rows
from filingfold.session import cut_lineage
from filingfold.sources.register import LocationInputs, Register
from filingfold.sources.schemas import ADMIN_NAME_COLUMNS
from tests.helpers import locations, register

N = 60_000


@contextlib.contextmanager
def small_thresholds(spark):
    forced = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in forced}
    for k, v in forced.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def split_and_count(spark, df) -> int:
    """Rows of ``df``; its final plan must hold a join that was split."""
    with small_thresholds(spark):
        n = len(df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "skew=true" in plan, plan[:3000]
    return n


@pytest.fixture(scope="module")
def hot(spark):
    """A register in which one person stands on half of the person rows, and one first
    filing has half of the later filings."""
    empty = register(spark)
    ids = spark.range(1, N + 1)
    half = lambda hot, other: F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(other)
    pers = ids.select(half(7, F.col("id") + 100).cast("long").alias("person_id"), F.col("id").alias("appln_id"), F.lit(1).alias("applt_seq_nr"), F.lit(1).alias("invt_seq_nr"))
    person = pers.select("person_id").distinct().withColumn("person_ctry_code", F.lit("DE"))
    return Register(
        appln=empty.appln, prior=empty.prior, tech_rel=empty.tech_rel, person=cut_lineage(person),
        pers_appln=cut_lineage(pers), publn=empty.publn, contn=empty.contn,
    )


def test_country_codes_and_own_code_rows(spark, hot):
    assert split_and_count(spark, country_codes(hot, "inv")) == N
    assert split_and_count(spark, own_code_rows(hot, COUNTRY_INV)) == N


def test_person_pool(spark, hot):
    pool = cut_lineage(spark.range(1, N + 1).select(
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).cast("long").alias("appln_id"), F.col("id").alias("subsequent_id"),
        F.lit(dt.date(2000, 1, 1)).alias("subsequent_date"), F.lit(1).alias("nb_priorities"), F.lit("priority").alias("type"),
    ))
    apps = cut_lineage(pool.select("appln_id").distinct().select("appln_id", F.lit("DE").alias("patent_office"), F.lit(2000).alias("appln_filing_year")))
    assert split_and_count(spark, person_pool(hot, pool, apps)) == N


def test_location_rows(spark, hot):
    base = locations(spark)
    address = spark.range(1, 3).select(*[
        {"location_id": F.col("id"), "unformattedaddress": F.concat(F.lit("a"), F.col("id").cast("string")), "data_source": F.lit("USPTO")}
        .get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in base.addresses.schema.fields
    ])
    loc = LocationInputs(
        addresses=cut_lineage(address), admin_levels=base.admin_levels,
        person_location=cut_lineage(hot.person.select("person_id", F.lit(1).cast("long").alias("location_id"))),
        addresses_pct=base.addresses_pct, appln_location_eu=base.appln_location_eu, appln_location_jp=base.appln_location_jp,
        appln_location_kr=base.appln_location_kr, appln_location_cn=base.appln_location_cn,
    )
    assert split_and_count(spark, location_rows(hot, loc)) == 2 * N


def test_names_of_a_hot_point_and_of_no_point(spark):
    df = cut_lineage(spark.range(N).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(1.5)).otherwise(F.col("id")).cast("decimal(20,10)").alias("lng_exact"),
        F.lit(1).cast("decimal(20,10)").alias("lat_exact"),
    ))
    names = cut_lineage(
        df.filter("lng_exact IS NOT NULL").select("lng_exact", "lat_exact").distinct()
        .select("*", *[F.lit("x").alias(c) for c in ADMIN_NAME_COLUMNS])
    )
    assert split_and_count(spark, attach_admin(df, names).select("id", "name_0")) == N
