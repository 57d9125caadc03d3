"""The end-to-end runner writes every result table, readable and complete."""

from __future__ import annotations

import os
import tempfile

import pytest

from filingfold.plans.run import run
from filingfold.sources.fixtures import fixture_inputs, fixture_root, star_state
from filingfold.sources.register import read_locations, read_register
from filingfold.sources.sinks import read_export

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_run_writes_every_result_table(spark):
    fixture_inputs(spark, SF)  # materialise the register tables as parquet
    root = fixture_root(spark, SF, star_state(spark, SF))
    reg, loc = read_register(spark, root), read_locations(spark, root)
    out = tempfile.mkdtemp(prefix="filingfold-run-")
    written = run(spark, reg, loc, out)
    assert set(written) == {
        "pf_inv_pers_ctry_all", "pf_app_pers_ctry_all", "ctry_inv_person_csv", "ctry_app_person_csv",
        "geoc_inv", "geoc_app", "family_bridge",
    }
    counts = {k: spark.read.parquet(v).count() for k, v in written.items() if not k.endswith("_csv")}
    # Same sizes as the registered queries at this scale (see test_oracle / FIXTURES.md).
    assert counts["family_bridge"] == 4336
    assert counts["geoc_inv"] == 1414
    assert counts["pf_app_pers_ctry_all"] == 808
    geoc = spark.read.parquet(written["geoc_inv"])
    assert {"geom", "geom_m"} <= set(geoc.columns) and "lastupdate" not in geoc.columns
    assert "lastupdate" in spark.read.parquet(written["pf_inv_pers_ctry_all"]).columns
    schema = spark.read.parquet(written["pf_app_pers_ctry_all"]).schema
    assert read_export(spark, written["ctry_app_person_csv"], schema).count() == 808
