from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingfold.llm import mixing as X
from tests.llm.helpers import DOCS, SF, empty_docs, odd_docs, odd_rows


def test_targets_stop_at_three_times_and_share_the_rest():
    got = X.targets(np.array([100, 100, 100]))
    assert got.tolist() == [187.5, 75.0, 37.5]
    got = X.targets(np.array([10, 1000, 1000, 0]))
    assert got[0] == 30 and got[3] == 0 and got.sum() == pytest.approx(2010) and got[1] / got[2] == pytest.approx(2)
    assert X.targets(np.zeros(3, int)).tolist() == [0, 0, 0] and len(X.targets(np.zeros(0, int))) == 0


def test_splitting_tree_is_exact_and_unbiased():
    quotas = np.array([500, 30, 0, 7, 1200])
    sums = np.zeros((8, 5))
    for seed in range(200):
        leaves = X.split_quotas(quotas, 8, np.random.default_rng(seed))
        assert leaves.sum(0).tolist() == quotas.tolist() and leaves.sum(1).max() - leaves.sum(1).min() <= 1
        sums += leaves
    assert np.allclose(sums / 200, quotas / 8, rtol=0.15, atol=0.5)


def test_op10_meets_targets(spark):
    rows = X.op10_source_mix(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    by: dict = {}
    for r in rows:
        assert r.size == len((docs[r.doc_id].text or "").split()) and 0 <= r.taken <= 3 * r.size
        by.setdefault(docs[r.doc_id].source, []).append(r)
    sizes = np.array([sum(r.size for r in by[s]) for s in sorted(by)])
    for target, s in zip(X.targets(sizes), sorted(by), strict=True):
        own = by[s]
        assert all(r.source_size == sum(x.size for x in own) and r.target == pytest.approx(target) for r in own)
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)
    again = X.op10_source_mix(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_many_blocks(spark, monkeypatch):
    """A block may be one long text, so the total is off by its longest text at most."""
    monkeypatch.setattr(X, "BLOCK_WORDS", 400)
    rows = X.op10_source_mix(spark, SF).collect()
    taken, target, longest = {}, {}, {}
    for r in rows:
        key = (r.source_size, r.target)
        taken[key] = taken.get(key, 0) + r.taken
        target[key] = r.target
        longest[key] = max(longest.get(key, 0), r.size)
    assert all(abs(taken[k] - target[k]) <= longest[k] for k in taken)


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = odd_docs(spark)
    mixed = X.mix(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert rows and {r.doc_id for r in rows} <= {r[0] for r in odd_rows()}
    assert max(sum(r.doc_id == i for r in rows) for i in (7, 9, 10)) <= 3
    assert X.mix(empty_docs(spark)).count() == 0


def test_large_output_shards_are_written_in_parts(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = X.mix(docs, shards=4)
    words = sum(len((r.text or "").split()) for r in docs.select("text").collect())
    monkeypatch.setattr(X, "PART_WORDS", words // 20)
    parts = X.mix(docs, shards=4)
    assert whole.rdd.getNumPartitions() <= 4 < parts.rdd.getNumPartitions()
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in parts.collect())


def test_too_many_sources_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(X, "MAX_SOURCES", 2)
    with pytest.raises(ValueError):
        X.mix(odd_docs(spark))


def test_a_long_text_does_not_starve_its_source(spark):
    """20 texts of 10 words and one of 6,000 under a target of 5,464: the short ones are
    taken three times each."""
    rows = [(i, " ".join(["w"] * 10), "en", "a", None) for i in range(20)] + [(20, " ".join(["w"] * 6000), "en", "a", None)]
    rows += [(100 + i, " ".join(["x"] * 10), "en", "b", None) for i in range(145)]
    out = X.drawn(spark.createDataFrame(rows, DOCS)).select("doc_id", "size", "target", F.size("taken_by").alias("n")).collect()
    a = [r for r in out if r.doc_id <= 20]
    assert 600 <= a[0].target < 6000 and max(r.n for r in out) <= X.MAX_REPEATS
    assert sum(r.size * r.n for r in a) == 600


def test_blocks_behind_one_that_does_not_fit_are_taken():
    import pandas as pd

    blocks = pd.DataFrame({"s": [0] * 6, "block": range(6), "words": [900, 10, 10, 10, 10, 10]})
    sources = pd.DataFrame({"source": ["a"], "source_size": [950], "target": [120.0], "n_blocks": [6]})
    for seed in range(20):
        plan = X.draw_plan(blocks, sources, 4, seed)
        assert sum(len(r[5]) * w for r, w in zip(plan, blocks["words"], strict=True)) == 120
