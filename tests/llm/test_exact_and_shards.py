from __future__ import annotations

import hashlib
import uuid
import zlib

import duckdb
import numpy as np

from pyspark.sql import functions as F

from filingfold.llm import exact_dedup as E
from pyspark.sql import functions as F

from filingfold.llm import sharding as S
from tests.llm.helpers import DOCS, SF, empty_docs, odd_docs, odd_rows


def test_op6_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(E.OP6_SQL).fetchall())
    assert sorted(map(tuple, E.op6_exact_dedup(spark, SF).collect())) == want


def test_index_takes_only_new_digests(spark):
    name = f"index_{uuid.uuid4().hex}"
    E.create_index(spark, name, buckets=4)
    batch = lambda rows: E.digests(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS))
    E.append_new(spark, name, batch([(1, "A"), (2, "a"), (3, "b")]), buckets=4)
    E.append_new(spark, name, batch([(9, "a"), (8, "c"), (7, "C")]), buckets=4)
    got = {r.digest: r.keep_id for r in spark.table(name).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {digest("a"): 2, digest("b"): 3, digest("c"): 8}
    plan = spark.table(name).select("digest").join(spark.table(name).withColumnRenamed("keep_id", "k").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text  # buckets spare the shuffle


def test_exact_dedup_odd_rows(spark):
    got = E.exact_dedup(spark, odd_docs(spark), buckets=4).collect()
    assert len(got) == len(odd_rows())
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups: dict = {}
    for r in odd_rows():
        groups.setdefault(low(r[1]), []).append(r[0])
    for r in got:
        own = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.digest)
        assert r.group_size == len(own) and r.keep_id == max((i for i in own if i is not None), default=None)
    assert E.exact_dedup(spark, empty_docs(spark), buckets=4).count() == 0


def jump(key: int, buckets: int) -> int:
    b, j = -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_plain_loop_and_moves_little():
    keys = np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64)
    for n in (1, 2, 7, 40):
        assert S.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]
    before, after = S.jump_hash(keys, 40), S.jump_hash(keys, 41)
    moved = before != after
    assert set(after[moved]) == {40} and abs(moved.mean() - 1 / 41) < 0.01


def test_op4(spark):
    rows = S.op4_jump_sharding(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    slots: dict = {}
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and r.law == "key"
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_odd_rows(spark):
    docs = odd_docs(spark)
    out = S.with_slots(S.assign(docs, 3), "text")
    got = out.collect()
    assert len(got) == len(odd_rows()) and set(docs.columns) <= set(out.columns)
    slots: dict = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert S.with_slots(S.assign(empty_docs(spark)), "text").count() == 0


def test_slots_of_sparse_dense_and_repeated_keys(spark, monkeypatch):
    """Blocks hold an even share of the rows whatever the keys are, and slots stay gapless."""
    monkeypatch.setattr(S, "BLOCK_ROWS", 100)
    for key in (F.xxhash64("id"), F.col("id"), F.lit(7).cast("long")):
        rows = spark.range(2000).select(key.alias("doc_id"), F.xxhash64(F.lit("t"), "id").alias("tie"))
        out = S.with_slots(S.assign(rows, 3), "tie")
        slots: dict = {}
        for r in out.collect():
            slots.setdefault(r.shard, []).append(r.slot)
        assert sum(map(len, slots.values())) == 2000
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    blocks = S.slot_block(20, "doc_id", "tie")
    for key in (F.xxhash64("id"), F.col("id"), F.lit(7).cast("long")):
        rows = spark.range(2000).select(key.alias("doc_id"), F.xxhash64(F.lit("t"), "id").alias("tie"))
        counts = [r["count"] for r in rows.groupBy(blocks.alias("b")).count().collect()]
        assert len(counts) == 20 and max(counts) < 160
