"""The thinned semi-join: equal rows, and a shuffle of the wanted share only."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filingfold.operators import prefilter
from filingfold.operators.prefilter import absent, bitmap_bits, existing, id_bitmap, thinned
from filingfold.session import cut_lineage


def test_bits_are_bounded():
    assert bitmap_bits(0) == prefilter.LEAST_BITS
    assert bitmap_bits(100_000) == 1 << 21
    assert bitmap_bits(prefilter.MOST_BITS // 9) == prefilter.MOST_BITS
    assert bitmap_bits(prefilter.MOST_BITS) is None


@pytest.mark.parametrize("share", [0, 1, 50])
def test_equals_the_plain_semi_join(spark, share, monkeypatch):
    monkeypatch.setattr(prefilter, "LEAST_ROWS", 0)
    big = spark.range(20_000).select((F.col("id") * 7919 % 9973 - 500).alias("k"), F.col("id").alias("block"), F.lit("x").alias("row"))
    big = big.unionByName(spark.createDataFrame([(None, 1, "n")], big.schema))
    ids = cut_lineage(spark.range(9_973).filter(F.col("id") % 100 < share).select((F.col("id") - 500).alias("id")))
    want = big.join(ids.select(F.col("id").alias("k")), "k", "left_semi")
    got = existing(big, "k", ids, "id")
    assert got.columns == big.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    others = absent(big, "k", ids.select(F.col("id").alias("k")))
    assert others.columns == big.columns
    left = big.join(ids.select(F.col("id").alias("k")), "k", "left_anti").select(*big.columns)
    assert sorted(map(str, others.collect())) == sorted(map(str, left.collect()))


def test_the_scan_lets_few_others_pass(spark):
    ids = spark.range(0, 300_000, 3)
    bits = bitmap_bits(100_000)
    kept = thinned(spark.range(300_000), "id", id_bitmap(ids, "id", bits), bits)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    others = kept.filter(F.col("id") % 3 != 0).count()
    assert kept.filter(F.col("id") % 3 == 0).count() == 100_000 and others < 200_000 / 10


def test_a_set_beyond_the_bound_is_joined_plainly(spark, monkeypatch):
    monkeypatch.setattr(prefilter, "LEAST_ROWS", 0)
    monkeypatch.setattr(prefilter, "MOST_BITS", 1 << 10)
    ids = cut_lineage(spark.range(5_000))
    assert existing(spark.range(9_000), "id", ids).count() == 5_000


def test_a_small_table_is_joined_plainly(spark):
    ids = cut_lineage(spark.range(5_000))
    plan = existing(spark.range(9_000), "id", ids)._jdf.queryExecution().analyzed().toString()
    assert "bitwise" not in plan.lower() and "words" not in plan


def test_country_and_bridge_with_the_bitmap_equal_the_plain_plans(spark, monkeypatch):
    from filingfold.config import COUNTRY_INV
    from filingfold.operators.bridge import bridge
    from filingfold.plans.country import impute_country
    from filingfold.sources.fixtures import fixture_inputs

    reg = fixture_inputs(spark, "/root/testdata/sf0.001")[0]

    def results():
        return [sorted(map(str, df.collect())) for df in (impute_country(reg, COUNTRY_INV, with_lastupdate=False), bridge(reg))]

    plain = results()
    monkeypatch.setattr(prefilter, "LEAST_ROWS", 0)
    assert results() == plain
