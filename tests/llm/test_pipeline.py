from __future__ import annotations

import corpus_pipeline as C
from filingfold.llm.minhash import near_duplicates
from filingfold.llm.sharding import jump_hash  # noqa: F401
from tests.llm.helpers import SF, empty_docs, odd_docs


def test_stages_in_sequence(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs
    counts = []
    for name, stage in C.STAGES[:-1]:
        rows = C.staged(stage(spark, rows, SF), name)
        assert rows.columns == docs.columns
        counts.append(rows.count())
        if name == "near_dedup":
            left = near_duplicates(rows).collect()
            assert all(r.doc_id == r.component_id for r in left)
    assert docs.count() > counts[0] > counts[1] > counts[2] > 0
    out = C.STAGES[-1][1](spark, rows, SF)
    assert set(out.columns) == {*docs.columns, "shard"} and out.count() == counts[3]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1}
    kept = {r.doc_id for r in C.quality(spark, docs, SF).collect()}
    assert len(good & kept) >= 0.99 * len(good)


def test_run_gives_the_same_rows_again(spark):
    a, b = (sorted((r.doc_id, r.shard) for r in C.run(spark, SF).collect()) for _ in range(2))
    assert a == b and a


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns[: len(docs.columns)] == docs.columns
            out.count()
