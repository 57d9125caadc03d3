"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Targets.  Each source's share of all words by weight, at most ``MAX_REPEATS``
   times its own words, the excess reshared (``targets``).
2. Blocks.  A source's documents fall into blocks by a hash, about ``BLOCK_WORDS``
   words each, more where that would give over ``MAX_BLOCKS`` blocks in all.  The
   block table (words per source and block) is therefore bounded at every input
   size, and only it and the source table reach the driver.
3. Quotas.  A source's draws are the blocks of its permuted block list, permuted anew
   for each repetition, that still fit the target when their turn comes; a part of the
   first that does not fit fills the rest.
4. Tree.  The vector of block quotas is split between the two halves of the output
   shards by one multivariate-hypergeometric draw, and so on down to single shards:
   each shard gets an exact number of blocks, in a mix that is distributed as if all
   draws were shuffled and dealt.  Shards take disjoint runs of the permuted lists.
5. Rows.  Documents meet the (bounded, broadcast) draw table by block; the last,
   partial block of a source gives documents in shuffled order as far as they fit,
   then its shortest others that fit the rest, then again from the shortest, up to the
   repeats that the block has left.  ``mix`` then shuffles each output shard locally by a hash.

Everything follows from ``seed`` and the rows, so reruns agree.

Defined cases: a null source is a source of its own, sorted last; a null or empty
text has size 0; repeated rows are rows of their own with the same draws (inside a
partial block one may be drawn and its equal not); an empty table gives an empty
result; a source without words has target 0.  More than ``MAX_SOURCES`` sources
raise an error, none is dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filingfold.llm.common import staged, table, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_WORDS = 32_768
MAX_BLOCKS = 65_536
MAX_SOURCES = 20_000
OUT_SHARDS = 64
#: Words that one task of ``mix`` writes, about; an output shard of more is written in parts.
PART_WORDS = 16_000_000
SEED = 20240601

DRAW_SCHEMA = "source string, source_size long, target double, n_blocks long, block long, shards array<int>, part_words double, part_shard int"


def targets(sizes: np.ndarray, weights=WEIGHTS, repeats: int = MAX_REPEATS) -> np.ndarray:
    """Words to take of each source (in code point order): shares of the whole by
    weight, none above ``repeats`` times its size."""
    share = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    cap, out = repeats * sizes.astype(float), np.zeros(len(sizes))
    open_, left = np.ones(len(sizes), bool), float(sizes.sum())
    while open_.any() and left > 0:
        out[open_] = left * share[open_] / share[open_].sum()
        over = open_ & (out > cap)
        if not over.any():
            break
        out[over] = cap[over]
        left -= cap[over].sum()
        open_ &= ~over
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) block counts: the splitting tree.  Shard sizes differ by at
    most one; column sums are the quotas."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    # Shard sizes are floor or ceil of the mean; the left half takes its exact part.
    total = int(quotas.sum())
    take = (total // shards) * left + min(total % shards, left)
    drawn = rng.multivariate_hypergeometric(quotas, take, method="marginals") if total else quotas * 0
    return np.concatenate([split_quotas(drawn, left, rng), split_quotas(quotas - drawn, shards - left, rng)])


def draw_plan(blocks: pd.DataFrame, sources: pd.DataFrame, shards: int, seed: int) -> list[tuple]:
    """One row (``DRAW_SCHEMA``) per block with the shards that draw it whole, and how many words the
    partial draw may take.  ``sources`` has source, source_size, target, n_blocks in
    order; ``blocks`` has source index ``s``, ``block`` and ``words``."""
    rng = np.random.default_rng(seed)
    by_source = {s: part for s, part in blocks.groupby("s")}
    taken, parts, ids_of = [], [], []
    for s, row in enumerate(sources.itertuples()):
        part = by_source.get(s)
        ids = part["block"].to_numpy() if part is not None else np.zeros(0, np.int64)
        words = part["words"].to_numpy() if part is not None else np.zeros(0, np.int64)
        order = np.concatenate([np.zeros(0, np.int64), *[rng.permutation(len(ids)) for _ in range(MAX_REPEATS)]]).astype(np.int64)
        own, first, left = [], -1, row.target + 1e-6
        for at, size in zip(order.tolist(), words[order].tolist(), strict=True):
            if size <= left:
                own.append(at)
                left -= size
            elif first < 0:
                first = at
        ids_of.append(ids)
        taken.append(own if row.target > 0 else [])
        parts.append((first, left) if row.target > 0 and left > 1e-6 else (-1, 0.0))
    leaves = split_quotas(np.array([len(t) for t in taken], np.int64), shards, rng)
    out = []
    for s, row in enumerate(sources.itertuples()):
        ids = ids_of[s]
        drawn: dict[int, list[int]] = {}
        for shard, at in zip(np.repeat(np.arange(shards), leaves[:, s]), taken[s], strict=True):
            drawn.setdefault(at, []).append(int(shard))
        part, rest = parts[s]
        part_shard = int(rng.integers(shards))
        for i, block in enumerate(ids):
            out.append((
                row.source, int(row.source_size), float(row.target), int(row.n_blocks), int(block), drawn.get(i, []),
                float(rest) if i == part else None, part_shard if i == part else None,
            ))
    return out


def _block(n_blocks: Column, seed: int) -> Column:
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"), F.col("_crc")), 11) / F.lit(float(1 << 53))
    return F.floor(u * n_blocks).cast("long")


def drawn(docs: DataFrame, weights=WEIGHTS, shards: int = OUT_SHARDS, seed: int = SEED) -> DataFrame:
    """(row, doc_id, size, source_size, target, taken_by): ``row`` holds the columns of
    ``docs`` (so no name of theirs can clash), ``taken_by`` the output shard of each
    time the row is taken."""
    return _drawn(docs, weights, shards, seed)[0]


def _drawn(docs: DataFrame, weights, shards: int, seed: int) -> tuple[DataFrame, int]:
    """``drawn`` and the number of words of all documents, which the mix comes near to."""
    spark = docs.sparkSession
    sized = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), "source", "doc_id",
        word_count(F.col("text")).alias("size"), F.crc32(F.col("text").cast("binary")).alias("_crc"),
    )
    narrow = staged(sized.select("source", "doc_id", "size", "_crc"), "sizes")
    totals = narrow.groupBy("source").agg(F.sum("size").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals = sorted(((r["source"], int(r["words"])) for r in totals), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = np.array([w for _, w in totals], np.int64)
    block_words = max(BLOCK_WORDS, -(-int(sizes.sum()) // MAX_BLOCKS))
    sources = pd.DataFrame({
        "source": pd.Series([s for s, _ in totals], dtype=object), "source_size": sizes,
        "target": targets(sizes, weights), "n_blocks": np.maximum(1, -(-sizes // block_words)),
    })
    known = spark.createDataFrame(
        [(n, int(b), i) for i, (n, b) in enumerate(zip(sources["source"], sources["n_blocks"], strict=True))],
        "source string, n_blocks long, s int",
    )
    matched = lambda left, right: left["source"].eqNullSafe(right["source"])
    blocks = (
        narrow.join(F.broadcast(known), matched(narrow, known)).drop(known["source"])
        .groupBy("s", _block(F.col("n_blocks"), seed).alias("block")).agg(F.sum("size").alias("words"))
        .orderBy("s", "block").toPandas()  # at most MAX_BLOCKS + one per source
    )
    plan = spark.createDataFrame(draw_plan(blocks, sources, shards, seed), DRAW_SCHEMA)
    draws = plan.select(F.col("source").alias("_source"), "source_size", "target", "block", "shards", "part_words", "part_shard")
    counts = known.select(F.col("source").alias("_name"), "n_blocks")
    # Both tables are bounded (MAX_SOURCES rows, MAX_BLOCKS + MAX_SOURCES rows).
    placed = sized.join(F.broadcast(counts), sized["source"].eqNullSafe(counts["_name"])).drop("_name")
    placed = placed.withColumn("_block", _block(F.col("n_blocks"), seed)).drop("n_blocks")
    met = placed.join(F.broadcast(draws), placed["source"].eqNullSafe(draws["_source"]) & (placed["_block"] == draws["block"]))
    whole = met.filter(F.col("part_words").isNull()).withColumn("taken_by", F.col("shards"))
    group = Window.partitionBy("_source", "block")
    upto = lambda *order: group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    shuffled = F.sum("size").over(upto(F.xxhash64(F.lit(seed + 1), "doc_id", "_crc"), "doc_id", "size"))
    partial = met.filter(F.col("part_words").isNotNull()).withColumn("upto", shuffled)
    partial = partial.withColumn("first", F.col("upto") <= F.col("part_words"))
    partial = partial.withColumn("rest", F.col("part_words") - F.coalesce(F.max(F.when(F.col("first"), F.col("upto"))).over(group), F.lit(0)))
    partial = partial.withColumn("upto", F.sum(F.when(F.col("first"), 0).otherwise(F.col("size"))).over(upto("size", "doc_id", "_crc")))
    more = (F.col("first") | (F.col("upto") <= F.col("rest"))) & (F.col("size") > 0)
    # Once more from the shortest, turn by turn, up to the block's repeats: the shortest that
    # fit, ``turn`` words together, are taken j times where j turns before them fit as well.
    partial = partial.withColumn("once", more.cast("int"))
    partial = partial.withColumn("rest", F.col("part_words") - F.sum(F.col("once") * F.col("size")).over(group))
    partial = partial.withColumn("upto", F.sum("size").over(upto("size", "doc_id", "_crc")))
    partial = partial.withColumn("fits", (F.col("size") > 0) & (F.col("upto") <= F.col("rest")))
    partial = partial.withColumn("turn", F.max(F.when(F.col("fits"), F.col("upto"))).over(group))
    again = F.least(F.lit(MAX_REPEATS - 1) - F.size("shards"), F.floor((F.col("rest") - F.col("upto")) / F.col("turn")).cast("int") + 1)
    copies = F.col("once") + F.when(F.col("fits"), again).otherwise(0)
    partial = partial.withColumn("taken_by", F.concat("shards", F.array_repeat("part_shard", copies)))
    columns = ["row", "doc_id", "size", "source_size", "target", "taken_by"]
    return whole.select(columns).unionByName(partial.select(columns)), int(sizes.sum())


def mix(docs: DataFrame, weights=WEIGHTS, shards: int = OUT_SHARDS, seed: int = SEED) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each time a document is
    taken; rows of an output shard lie together, in shuffled order (a large shard in parts)."""
    rows, words = _drawn(docs, weights, shards, seed)
    taken = rows.select("row", "doc_id", F.posexplode("taken_by").alias("turn", "shard"))
    parts = max(1, -(-words // (shards * PART_WORDS)))
    # A part is a range of places, so the parts of a shard are its shuffled order cut in pieces.
    part = F.floor(F.shiftrightunsigned("place", 11) / F.lit(float(1 << 53)) * parts)
    return (
        taken.withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "turn", "shard")).withColumn("part", part)
        .repartition(shards * parts, "shard", "part").sortWithinPartitions("shard", "part", "place").select("row.*")
    )


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return drawn(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("taken_by")).cast("long").alias("taken")
    )
