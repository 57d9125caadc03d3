"""Jump consistent hashing: stable keys to shards without a ring table.

A key's shard follows from its 64-bit hash and the shard count alone; going from n
to n + 1 shards moves a key only into the new shard, and moves 1 / (n + 1) of them.

Slots number the rows of a shard from 0 without gaps.  They come from two levels, so
that no task holds a whole shard: rows are numbered inside (shard, block), a block being
a range of hashes of key and tie, as many as the row count asks for, so dense, sparse and
repeated keys fill them alike; a running sum over the small table of block counts gives
each block's first slot.

Defined cases: a null key is hashed like any other value (all its rows share one
shard; their blocks go by the tie); a null text has no bytes and checksum 0;
equal rows get slots in arbitrary but gapless order; an empty table gives an empty
result; other columns pass through; existing columns named as the results (shard,
slot) are replaced by ``assign`` and must not be in the input of ``with_slots``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filingfold.llm.common import staged, table

SHARDS = 40
BLOCK_ROWS = 1 << 16
ROW_BYTES = 16


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key (Lamping and Veach 2014), all keys in step."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    jump = np.zeros(len(state), np.int64)
    while len(live):
        shard[live] = jump
        state = state * np.uint64(2862933555777941757) + np.uint64(1)
        jump = ((jump + 1) * (float(1 << 31) / ((state >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        go = jump < shards
        live, jump, state = live[go], jump[go], state[go]
    return shard.astype(np.int32)


def jump_udf(shards: int):
    @F.pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(key.to_numpy(np.int64).view(np.uint64), shards))

    return shard_of


def assign(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", into: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row in column ``into``."""
    return docs.withColumn(into, jump_udf(shards)(F.xxhash64(F.col(key))))


def slot_block(blocks: int, key: str, tie: str) -> Column:
    """The block of a row: ``blocks`` even ranges of the hash of key and tie."""
    even = F.shiftrightunsigned(F.xxhash64(F.lit(1), F.col(key), F.col(tie)), 11) / F.lit(float(1 << 53))
    return F.floor(even * blocks)


def with_slots(rows: DataFrame, tie: str, key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """``rows`` with a gapless ``slot`` in each shard; ``tie`` orders equal keys.  The rows are
    counted first, so they should be a written table."""
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    block = slot_block(blocks, key, tie)
    packed = rows.select(  # packed, so that no column of ``rows`` can clash
        F.struct(*[rows[c] for c in rows.columns]).alias("row"), F.col(shard).alias("shard"), block.alias("block"),
        F.col(key).alias("key"), F.col(tie).alias("tie"),
    )
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        packed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "block").orderBy("key", "tie")
    slot = (F.col("start") + F.row_number().over(inside) - 1).cast("long")
    return packed.join(starts, ["shard", "block"]).select("row", slot.alias("slot")).select("row.*", "slot")


def op4_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    rows = staged(assign(assign(docs, SHARDS), SHARDS + 1, into="grown_shard"), "shards")
    return with_slots(rows, "text_crc32").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
