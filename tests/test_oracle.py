"""Every query of the inventory equals its DuckDB oracle at sf0.001."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from filingfold.oracles import oracle_queries
from filingfold.queries import QUERIES
from tools.compare import duck, multiset

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    srows = [tuple(r) for r in sdf.collect()]
    assert len(srows) == len(orows)
    assert multiset(srows, sdf.columns) == multiset(orows, ocols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "source" in df.columns and "country" in df.columns
