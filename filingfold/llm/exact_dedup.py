"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

The index is a Parquet table with one row per distinct normalised text: its SHA-256
and the doc_id that represents it.  New data is reduced to one row per digest,
anti-joined against the index (sort-merge; the index side needs no exchange, its
buckets are the join's partitions) and the digests not seen before are appended.

Normalisation lower-cases A-Z only.  Defined cases: a null text counts as empty;
of equal texts the largest doc_id stays, a null doc_id only if the group has no
other; rows that repeat a doc_id within a group are kept or dropped together (they
cannot be told apart); an empty input leaves the index as it is; extra columns are
ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import ascii_lower, staged, table, text_or_empty

BUCKETS = 16


def create_index(spark: SparkSession, name: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Create the index table, or open the one that lies at ``path``."""
    location = f"LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, keep_id BIGINT) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS {location}"
    )


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(ascii_lower(text_or_empty()).cast("binary"), 256).alias("digest"),
    )


def append_new(spark: SparkSession, name: str, keyed: DataFrame, buckets: int = BUCKETS) -> None:
    """Append the digests of ``keyed`` (doc_id, digest) that the index does not hold."""
    batch = keyed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
    fresh = batch.join(spark.table(name).select("digest").hint("merge"), "digest", "left_anti")
    (
        # One task per bucket, so that an append adds one sorted file to each bucket.
        staged(fresh, "digest-batch").repartition(buckets, "digest")
        .write.format("parquet").mode("append").bucketBy(buckets, "digest").sortBy("digest").saveAsTable(name)
    )


def resolve(spark: SparkSession, name: str, keyed: DataFrame) -> DataFrame:
    """Every row of ``keyed`` with its representative and the size of its group.

    The per-digest side is staged first: both sides of the last join then come from
    an exchange, and AQE can split a digest that a third of all rows share."""
    sizes = keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = staged(sizes.join(spark.table(name), "digest"), "digest-groups")
    return keyed.join(groups, "digest").select("doc_id", "keep_id", "group_size", "digest")


def exact_dedup(spark: SparkSession, docs: DataFrame, name: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Dedup ``docs`` through a fresh index, in two appends: newer ids first, so that
    the largest doc_id of a text represents it, then the older ones, which meet the
    index in the anti-join."""
    name = name or f"digest_index_{uuid.uuid4().hex}"
    create_index(spark, name, buckets)
    keyed = staged(digests(docs), "digests")
    low, high = keyed.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if low is None else low + (high - low) // 2
    newer = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    append_new(spark, name, keyed.filter(newer), buckets)
    append_new(spark, name, keyed.filter(~newer), buckets)
    return resolve(spark, name, keyed)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup(spark, table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


OP6_SQL = """
WITH keyed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), sized AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM keyed GROUP BY text_sha256
)
SELECT k.doc_id, s.keep_id, s.group_size, k.doc_id IS NOT DISTINCT FROM s.keep_id AS kept, k.text_sha256
FROM keyed k JOIN sized s ON k.text_sha256 = s.text_sha256
"""
