"""Steps that were made to move fewer bytes: what is written, exchanged and held."""

from __future__ import annotations

import os
import tempfile
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from filingfold.operators.bridge import _flags
from filingfold.operators.info import address_ids, location_rows, role_rows
from filingfold.plans.refresh import changed_rows
from filingfold.queries import QUERIES
from filingfold.session import cut_lineage
from filingfold.sources.fixtures import FIXTURE_TABLES, fixture_inputs, fixture_root, star_state
from filingfold.sources.layout import hot_ids_of, lay_out
from filingfold.sources.register import LaidOutRegister, Register


@pytest.fixture(scope="module")
def star():
    """A small star schema with every flag, repeated lines and an order without customer."""
    d = tempfile.mkdtemp(prefix="filingfold-star-")
    n = 240
    pd.DataFrame({"r_regionkey": [0], "r_name": ["R"]}).astype({"r_regionkey": "int32"}).to_parquet(f"{d}/region.parquet")
    pd.DataFrame({"n_nationkey": range(25), "n_name": [f"N{i}" for i in range(25)], "n_regionkey": 0}).astype(
        {"n_nationkey": "int32", "n_regionkey": "int32"}).to_parquet(f"{d}/nation.parquet")
    pd.DataFrame({"c_custkey": range(30), "c_nationkey": [i % 25 for i in range(30)]}).astype({"c_nationkey": "int32"}).to_parquet(f"{d}/customer.parquet")
    pd.DataFrame({"s_suppkey": range(12), "s_nationkey": [i % 25 for i in range(12)]}).astype({"s_nationkey": "int32"}).to_parquet(f"{d}/supplier.parquet")
    pd.DataFrame({"p_partkey": range(40)}).to_parquet(f"{d}/part.parquet")
    pd.DataFrame({
        "o_orderkey": range(n), "o_custkey": [i * 7 % 31 for i in range(n)], "o_orderstatus": ["FO"[i % 2] for i in range(n)],
        "o_orderdate": pd.to_datetime([f"{1990 + i % 20}-0{1 + i % 9}-11" for i in range(n)]).astype("datetime64[us]"),
    }).to_parquet(f"{d}/orders.parquet")
    lines = pd.DataFrame([
        {"l_orderkey": i, "l_partkey": (i * 3 + k) % 40, "l_suppkey": (i + 5 * k) % 12, "l_linenumber": k, "l_returnflag": "RAN"[(i + k) % 3]}
        for i in range(n) for k in (1, 2, 3, 4)
    ]).astype({"l_linenumber": "int32"})
    pd.concat([lines, lines.head(50)]).to_parquet(f"{d}/lineitem.parquet")
    return d


def rows_of(df) -> Counter:
    return Counter(str(tuple(r)) for r in df.collect())


def test_only_the_tables_a_query_repeats_are_written_and_all_are_the_same(spark, star):
    root = fixture_root(spark, star, star_state(spark, star))
    reg, loc = fixture_inputs(spark, star, ("appln",))
    assert os.listdir(root) == ["tls201_appln"]
    derived = {f: rows_of(getattr(reg if hasattr(reg, f) else loc, f)) for f in FIXTURE_TABLES}
    reg, loc = fixture_inputs(spark, star)
    assert sorted(os.listdir(root)) == sorted(FIXTURE_TABLES.values())
    assert {f: rows_of(getattr(reg if hasattr(reg, f) else loc, f)) for f in FIXTURE_TABLES} == derived
    assert all(derived.values())


def test_every_field_of_a_register_is_a_table(spark, star):
    reg, _ = fixture_inputs(spark, star)
    assert all(getattr(reg, f).columns for f in Register.__dataclass_fields__) and reg.layout is None
    laid_out = lay_out(reg, 8)
    assert isinstance(laid_out, LaidOutRegister) and laid_out.layout.buckets == 8


def test_codes_of_later_filings_are_computed_once(spark, star):
    for name in ("earliest_other", "earliest_equivalent_app"):
        plan = QUERIES[name](spark, star)._jdf.queryExecution().optimizedPlan().toString()
        assert "invt_seq_nr" not in plan and "applt_seq_nr" not in plan


def test_rows_of_one_role_and_distinct_sides(spark, star):
    reg, loc = fixture_inputs(spark, star)
    ids = address_ids(loc)
    both = cut_lineage(location_rows(reg, loc, ids))
    assert both.count() == both.distinct().count() > 0
    for role in ("inv", "app"):
        one = location_rows(reg, loc, ids, role)
        assert rows_of(role_rows(one, role)) == rows_of(role_rows(both, role)) and one.filter(F.col("role") != role).isEmpty()


def test_places_are_joined_by_point(spark, star):
    plan = QUERIES["direct_own_locations"](spark, star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lat_exact") and not [x for x in plan.splitlines() if "Aggregate" in x and "lat_exact" in x]


def test_hot_ids_without_an_exchange_by_id(spark):
    n = 8000
    df = cut_lineage(spark.range(n).select(
        F.when(F.col("id") % 5 == 0, 7).when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 7 == 0, 9).otherwise(F.col("id")).cast("long").alias("k")))
    share = n // 8
    exact = {r.k for r in df.filter("k IS NOT NULL").groupBy("k").count().filter(F.col("count") > share).collect()}
    assert {r.k for r in hot_ids_of(df, "k", 8).collect()} == exact == {7}
    assert hot_ids_of(df.limit(0), "k", 8).isEmpty()


def test_flags_take_one_exchange(spark):
    a, b = cut_lineage(spark.range(1, 6)), cut_lineage(spark.range(4, 9).unionByName(spark.range(4, 6)))
    flags = _flags((a, "x"), (b, "y"))
    assert {(r.appln_id, r.x, r.y) for r in flags.collect()} == {(i, i < 6, i > 3) for i in range(1, 9)}
    assert flags.count() == 8 and flags._jdf.queryExecution().sparkPlan().toString().count("Join") == 0


def test_changed_rows_ship_one_hash(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "id long, v string")
    new = spark.createDataFrame([(1, "a"), (2, ""), (3, "c"), (4, None)], "id long, v string")
    found = changed_rows(old, new, ("id",))
    assert sorted(r.id for r in found.collect()) == [1, 2, 2, 4]
    assert "h2" not in found._jdf.queryExecution().optimizedPlan().toString()
