"""Reading a parquet register: declared columns are cast, extra publication columns
are carried through the bridge (the reference selects every publication column)."""

from __future__ import annotations

import datetime as dt
import os
import shutil
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from filingfold.operators.bridge import bridge
from filingfold.session import ensure_checkpoint_dir
from filingfold.sources.fixtures import STAR_TABLES, fixture_inputs
from filingfold.sources.register import read_register
from tests.helpers import appln, register


def test_extra_publication_columns_reach_the_bridge(spark):
    reg = register(
        spark,
        appln_rows=[appln(1, docdb_family_id=5), appln(2, docdb_family_id=5)],
        prior=[(2, 1, 1)],
        publn=[(11, "DE", "1", "A1", 1), (21, "DE", "2", "A1", 2)],
    )
    base = tempfile.mkdtemp(prefix="filingfold-reg-")
    for name, df in {
        "tls201_appln": reg.appln,
        "tls204_appln_prior": reg.prior.withColumn("prior_appln_seq_nr", F.col("prior_appln_seq_nr").cast("long")),
        "tls205_tech_rel": reg.tech_rel,
        "tls206_person": reg.person,
        "tls207_pers_appln": reg.pers_appln,
        "tls211_pat_publn": reg.publn.withColumn("publn_date", F.lit(dt.date(2003, 3, 3))),
        "tls216_appln_contn": reg.contn,
    }.items():
        df.write.parquet(f"{base}/{name}")
    loaded = read_register(spark, base)
    assert dict(loaded.prior.dtypes)["prior_appln_seq_nr"] == "int"
    out = bridge(loaded)
    assert "publn_date" in out.columns
    got = sorted((r.prior_appln_id, r.appln_id, r.type, r.publn_date) for r in out.collect())
    assert got == [(1, 1, "PRIORITY", dt.date(2003, 3, 3)), (1, 2, "PRIORITY", dt.date(2003, 3, 3))]


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder and folder == spark.sparkContext.getCheckpointDir()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_new_data_under_one_path_gives_new_answers(spark):
    star = tempfile.mkdtemp(prefix="filingfold-star-")
    for name in STAR_TABLES:
        shutil.copyfile(f"/root/testdata/sf0.001/{name}.parquet", f"{star}/{name}.parquet")
    before = fixture_inputs(spark, star)[0].person
    assert fixture_inputs(spark, star)[0].person is before  # same files, same tables
    n = before.count()
    pd.read_parquet(f"{star}/supplier.parquet").head(5).to_parquet(f"{star}/supplier.parquet")
    after = fixture_inputs(spark, star)[0].person.count()
    assert after < n and before.count() == n
