"""A register laid out for joins on the application: bucketed and sorted tables.

``lay_out`` writes each table once, bucketed by the id it is joined on: tls201 and tls207
by application, and the link tables tls204, 205 and 216 twice, by the first filing they
name and by the later filing that names it.  Plans over such a register join and
aggregate bucket by bucket, without an exchange of any of these tables.

A bucket is one task, which AQE cannot split, so ids with more rows than an even share of
a bucket (``hot``; at most as many ids as there are buckets) are kept apart in a table
that is not bucketed.  Their rows are spread over all tasks and meet the one row of their
id by broadcast; no other id can make a bucket more than twice as large as its share.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from .register import LaidOutRegister, Register

ROWS_PER_BUCKET = 2_000_000
SLOTS_PER_BUCKET = 64


@dataclass(frozen=True)
class Keyed:
    """A table by ``key``: ``cold`` in buckets, ``hot`` the rows of the ids in ``hot_ids``."""

    key: str
    cold: DataFrame
    hot: DataFrame
    hot_ids: DataFrame

    def rows_of(self, ids: DataFrame, finish: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """Inner join with ``ids``, a bucketed table with one row per ``key``.  ``finish``
        is applied to either part: what it groups by must contain the key."""
        few = F.broadcast(ids.join(F.broadcast(self.hot_ids), self.key))
        return finish(ids.join(self.cold, self.key)).unionByName(finish(few.join(self.hot, self.key)))

    def attach(self, ids: DataFrame, **aggregates: F.Column) -> DataFrame:
        """``ids`` with aggregates over the rows of each id (null where it has none)."""
        aggs = [a.alias(n) for n, a in aggregates.items()]
        cold = ids.join(self.cold.groupBy(self.key).agg(*aggs), self.key, "left")
        hot = self.hot.groupBy(self.key).agg(*[a.alias(f"hot_{n}") for n, a in aggregates.items()])
        both = cold.join(F.broadcast(hot), self.key, "left")  # at most a row for each bucket
        return both.select(*ids.columns, *[F.coalesce(F.col(f"hot_{n}"), F.col(n)).alias(n) for n in aggregates])


@dataclass(frozen=True)
class Layout:
    buckets: int
    persons: Keyed  # tls207 by application
    by_first: dict[str, Keyed]  # link tables by the first filing, as appln_id
    by_later: dict[str, Keyed]  # and by the later filing, as subsequent_id


def written_in_buckets(df: DataFrame, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` below the shared folder and read it
    back.  ``dealt``: its rows already lie in tasks by bucket, and are not exchanged."""
    spark, name = df.sparkSession, f"laid_out_{uuid.uuid4().hex}"
    df = df if dealt else df.repartition(buckets, key)
    path = f"{ensure_checkpoint_dir(spark)}/{name}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def hot_ids_of(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Ids with more than an even share of a bucket.  Rows are first counted by a hash of
    the id, in so few slots that the counts combine before the exchange; only the rows of a
    slot with more than a share, which an id of that size makes it, are counted by id."""
    slot = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets * SLOTS_PER_BUCKET)))
    slots = cut_lineage(df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("rows")))
    share = max(1, (slots.agg(F.sum("rows")).first()[0] or 0) // buckets)
    crowded = slots.filter((F.col("rows") > share) & F.col("slot").isNotNull()).select("slot")
    counts = df.withColumn("slot", slot).join(F.broadcast(crowded), "slot", "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return cut_lineage(counts.filter(F.col("rows") > share).select(key))


def keyed(df: DataFrame, key: str, buckets: int) -> Keyed:
    """``df`` by ``key``, ids with more than an even share of a bucket kept apart."""
    hot_ids = hot_ids_of(df, key, buckets)
    hot = cut_lineage(df.join(F.broadcast(hot_ids), key, "left_semi"))
    cold = written_in_buckets(df.join(F.broadcast(hot_ids), key, "left_anti"), key, buckets)
    return Keyed(key, cold, hot, hot_ids)


def lay_out(reg: Register, buckets: int | None = None) -> Register:
    """``reg`` with its tables in buckets.  ``buckets``: from the rows of the largest
    table if not given."""
    if buckets is None:
        buckets = max(8, reg.pers_appln.count() // ROWS_PER_BUCKET)
    links = {
        "priority": (reg.prior, "prior_appln_id", F.col("prior_appln_seq_nr")),
        "continual": (reg.contn, "parent_appln_id", F.lit(None).cast("int")),
        "tech_rel": (reg.tech_rel, "tech_rel_appln_id", F.lit(None).cast("int")),
    }
    by_first, by_later = {}, {}
    for type_, (table, first, seq) in links.items():
        rows = table.select(F.col(first).alias("appln_id"), F.col("appln_id").alias("subsequent_id"), seq.alias("seq"))
        by_first[type_] = keyed(rows.select("appln_id", "subsequent_id"), "appln_id", buckets)
        by_later[type_] = keyed(rows.select("subsequent_id", "seq"), "subsequent_id", buckets)
    tables = {name: getattr(reg, name) for name in Register.__dataclass_fields__}
    return LaidOutRegister(**tables | dict(
        appln=written_in_buckets(reg.appln, "appln_id", buckets),
        layout=Layout(buckets, keyed(reg.pers_appln, "appln_id", buckets), by_first, by_later),
    ))
