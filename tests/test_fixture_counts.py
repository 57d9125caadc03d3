"""Counts measured with DuckDB over the adapter's SQL (FIXTURES.md, sf0.001).

They pin the adapter and the pipelines together.  The counts have the year
window on for both roles, so the inventor preset is checked with it switched on.
"""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from filingfold.config import COUNTRY_APP, COUNTRY_INV, DEFAULT_YEAR_RANGE, LOCATION_INV
from filingfold.operators.bridge import bridge
from filingfold.operators.classify import first_filings
from filingfold.plans.country import impute_country
from filingfold.plans.location import impute_location
from filingfold.sources.fixtures import fixture_inputs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
INV_YEARS = replace(COUNTRY_INV, year_range=DEFAULT_YEAR_RANGE)

# (applications, rows) per first-filing type.
FIRST_FILINGS = {
    "app": {"priority": (153, 235), "pct": (153, 242), "continual": (91, 141), "tech_rel": (63, 105), "single": (204, 314)},
    "inv": {"priority": (150, 525), "pct": (153, 553), "continual": (88, 279), "tech_rel": (60, 205), "single": (199, 659)},
    "loc": {"priority": (128, 454), "pct": (137, 137), "continual": (73, 232), "tech_rel": (45, 157), "single": (165, 547)},
}
# (applications, rows) per source, and unresolved applications.
WATERFALL = {
    "app": ({1: (282, 332), 2: (136, 150), 3: (73, 84), 4: (122, 160), 5: (4, 46), 7: (30, 36)}, 17),
    "inv": ({1: (487, 704), 2: (83, 131), 3: (13, 22), 4: (22, 22), 6: (1, 1), 7: (27, 64)}, 17),
    "loc": ({1: (292, 793), 2: (121, 541), 3: (11, 23), 4: (49, 52), 5: (1, 5)}, 74),
}
BRIDGE = {"PRIORITY": (200, 2611), "PCT": (49, 150), "CONTINUAL": (85, 794), "TECH_REL": (46, 750), "SINGLE": (31, 31)}
CONFIGS = {"app": COUNTRY_APP, "inv": INV_YEARS, "loc": LOCATION_INV}


@pytest.fixture(scope="module")
def inputs(spark):
    return fixture_inputs(spark, SF)


def _per(df, key):
    rows = df.groupBy(key).agg(F.countDistinct("appln_id").alias("a"), F.count(F.lit(1)).alias("n")).collect()
    return {r[0]: (r.a, r.n) for r in rows}


@pytest.mark.parametrize("name", ["app", "inv", "loc"])
def test_first_filing_counts(inputs, name):
    reg, _ = inputs
    assert _per(first_filings(reg, CONFIGS[name]), "type") == FIRST_FILINGS[name]


@pytest.mark.parametrize("name", ["app", "inv", "loc"])
def test_waterfall_counts(inputs, name):
    reg, loc = inputs
    cfg = CONFIGS[name]
    out = impute_location(reg, loc, cfg) if name == "loc" else impute_country(reg, cfg)
    expected, unresolved = WATERFALL[name]
    assert _per(out, "source") == expected
    apps = first_filings(reg, cfg).select("appln_id").distinct()
    assert apps.join(out.select("appln_id"), "appln_id", "left_anti").count() == unresolved


def test_bridge_counts(inputs):
    reg, _ = inputs
    got = {
        r.type: (r.p, r.n)
        for r in bridge(reg).groupBy("type").agg(F.countDistinct("prior_appln_id").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    }
    assert got == BRIDGE
