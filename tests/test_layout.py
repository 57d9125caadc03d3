"""The bucketed register: no exchange of its tables, hot ids spread, equal answers."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from filingfold.config import COUNTRY_APP, COUNTRY_INV, LOCATION_INV
from filingfold.operators.classify import first_filing_applications, first_filings
from filingfold.operators.pool import linked_pool
from filingfold.plans.country import impute_country
from filingfold.sources.fixtures import fixture_inputs
from filingfold.sources.layout import keyed, lay_out, written_in_buckets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def registers(spark):
    reg = fixture_inputs(spark, SF)[0]
    return reg, lay_out(reg, 5)


@pytest.fixture
def no_broadcast(spark):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def same(a, b):
    assert a.columns == b.columns or sorted(a.columns) == sorted(b.columns)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


@pytest.mark.parametrize("cfg", [COUNTRY_INV, COUNTRY_APP, LOCATION_INV])
def test_first_filings_and_pool_are_equal(registers, cfg):
    plain, laid = registers
    same(first_filings(plain, cfg), first_filings(laid, cfg))
    apps = first_filing_applications(first_filings(plain, cfg))
    bucketed = written_in_buckets(apps, "appln_id", 5)
    same(linked_pool(plain, apps), linked_pool(laid, bucketed))


@pytest.mark.parametrize("cfg", [COUNTRY_INV, COUNTRY_APP])
def test_country_is_equal(registers, cfg, no_broadcast):
    plain, laid = registers
    same(impute_country(plain, cfg, with_lastupdate=False), impute_country(laid, cfg, with_lastupdate=False))


def exchanged(plan: str) -> list[str]:
    """The part of the plan below each exchange."""
    lines, parts = plan.splitlines(), []
    depth = [len(re.match(r"[\s:+|-]*(\*\(\d+\) )?", x)[0].replace("*", "").rstrip("0123456789() ")) for x in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            j = i + 1
            while j < len(lines) and depth[j] > depth[i]:
                j += 1
            parts.append("\n".join(lines[i:j]))
    return parts


def plans_of_writes(spark, run) -> list[str]:
    """Plans of all that ``run`` writes or returns."""
    from filingfold.sources import layout

    seen, write = [], layout.written_in_buckets

    def watched(df, key, buckets, dealt=False):
        if dealt:
            seen.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, key, buckets, dealt)

    with pytest.MonkeyPatch.context() as patch:
        for module in ("filingfold.operators.classify", "filingfold.operators.pool", "filingfold.plans.country"):
            patch.setattr(f"{module}.written_in_buckets", watched)
        seen.append(run()._jdf.queryExecution().executedPlan().toString())
    return seen


def test_no_exchange_of_the_register(spark, registers, no_broadcast):
    laid = registers[1]
    plans = plans_of_writes(spark, lambda: first_filings(laid, COUNTRY_INV))
    assert len(plans) == 2 and all("laid_out_" in p for p in plans)
    for part in (x for p in plans for x in exchanged(p)):
        # Only families are exchanged, by family and, those of one, by application; and
        # rows of hot ids, which meet the one row of their id by broadcast.
        hot = 0 <= part.find("BroadcastExchange") < part.find("laid_out_")
        assert "laid_out_" not in part or "docdb_family_id" in part or hot, part
    joined = laid.appln.join(laid.layout.persons.cold, "appln_id")
    assert exchanged(joined._jdf.queryExecution().executedPlan().toString()) == []


def test_hot_ids_lie_apart(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    table = keyed(rows, "k", 8)
    assert [r.k for r in table.hot_ids.collect()] == [7]
    assert table.hot.count() + table.cold.count() == 10_000 and table.cold.filter("k = 7").count() == 0
    ids = written_in_buckets(spark.range(9_000).withColumnRenamed("id", "k"), "k", 8)
    assert table.rows_of(ids).count() == rows.join(ids, "k").count()
    summed = {r.k: r.s for r in table.attach(ids, s=F.sum("v")).collect()}
    want = {r.k: r.s for r in rows.groupBy("k").agg(F.sum("v").alias("s")).collect()}
    assert summed == {k: want.get(k) for k in range(9_000)}
