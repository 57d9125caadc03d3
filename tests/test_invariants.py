"""Invariants of the pipelines on the driver's smallest fixture."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filingfold.config import COUNTRY_APP, COUNTRY_INV, LOCATION_INV
from filingfold.operators.bridge import bridge
from filingfold.operators.classify import first_filings
from filingfold.plans.country import impute_country
from filingfold.plans.location import impute_location
from filingfold.sources.fixtures import fixture_inputs
from filingfold.sources.register import Register

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def inputs(spark):
    return fixture_inputs(spark, SF)


def test_one_type_per_first_filing(inputs):
    reg, _ = inputs
    for cfg in (COUNTRY_APP, COUNTRY_INV, LOCATION_INV):
        pf = first_filings(reg, cfg)
        assert pf.groupBy("appln_id").agg(F.countDistinct("type").alias("n")).filter("n > 1").count() == 0


def test_one_source_per_application_and_outputs_inside_first_filings(inputs):
    reg, loc = inputs
    for out, cfg in ((impute_country(reg, COUNTRY_INV), COUNTRY_INV), (impute_location(reg, loc, LOCATION_INV), LOCATION_INV)):
        assert out.groupBy("appln_id").agg(F.countDistinct("source").alias("n")).filter("n > 1").count() == 0
        pf_ids = first_filings(reg, cfg).select("appln_id").distinct()
        assert out.select("appln_id").distinct().join(pf_ids, "appln_id", "left_anti").count() == 0


def test_every_application_filled_or_unresolved(inputs):
    reg, _ = inputs
    out = impute_country(reg, COUNTRY_APP)
    pf = first_filings(reg, COUNTRY_APP)
    filled = out.select("appln_id").distinct().count()
    unresolved = pf.select("appln_id").distinct().join(out.select("appln_id"), "appln_id", "left_anti").count()
    assert filled + unresolved == pf.select("appln_id").distinct().count()
    # Unresolved applications are exactly those at a barred (or NULL) office with no tier 1-6 answer.
    assert unresolved > 0


def test_bridge_members_are_published(inputs):
    reg, _ = inputs
    b = bridge(reg)
    assert b.join(reg.publn.select("appln_id").distinct(), "appln_id", "left_anti").count() == 0


def test_result_does_not_depend_on_partitioning(inputs, spark):
    reg, _ = inputs
    shuffled = Register(**{k: getattr(reg, k).repartition(7) for k in Register.__dataclass_fields__})
    a = Counter(tuple(r) for r in impute_country(reg, COUNTRY_APP, with_lastupdate=False).collect())
    b = Counter(tuple(r) for r in impute_country(shuffled, COUNTRY_APP, with_lastupdate=False).collect())
    assert a == b
