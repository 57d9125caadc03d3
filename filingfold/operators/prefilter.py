"""Semi-joins whose big side is thinned inside its scan.

``existing`` keeps the rows of a large table whose id is in a set of ids.  A plain
semi-join sends all of the table through an exchange; here a bitmap of hashed ids, of a
size that is bounded and follows the set, is broadcast first and tested row by row in
the scan's own stage, so only rows that are very likely wanted are shuffled.  The exact
semi-join follows and drops the few that share a bit with a wanted id.  A set too large
for the bitmap to help is joined without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: A bit set for one id lets another pass with a probability of 1 / BITS_PER_ID at most.
BITS_PER_ID = 16
LEAST_BITS = 1 << 16
#: 64 MB, the most that is broadcast.
MOST_BITS = 1 << 29
LEAST_ROWS = 2_000_000
_WORD, _BLOCK = 6, 16  # bits of a long, and of the 1,024 longs of a row


def bitmap_bits(n: int) -> int | None:
    """Bits for ``n`` ids, a power of two; None where the bound allows less than half of
    ``BITS_PER_ID`` an id."""
    wanted = max(LEAST_BITS, 1 << max(0, BITS_PER_ID * n - 1).bit_length())
    return min(wanted, MOST_BITS) if 2 * MOST_BITS >= BITS_PER_ID * n else None


def _place(column: str, bits: int) -> F.Column:
    return F.xxhash64(F.col(column)).bitwiseAND(F.lit(bits - 1))


def id_bitmap(ids: DataFrame, column: str, bits: int) -> DataFrame:
    """(block, words): the bitmap of ``column``, 1,024 longs a row, written out."""
    spark = ids.sparkSession
    at = _place(column, bits)
    bit = F.expr(f"shiftleft(1L, cast(xxhash64({column}) & 63 as int))")
    set_bits = ids.filter(F.col(column).isNotNull()).select(F.shiftright(at, _WORD).alias("word"), bit.alias("bit"))
    zero = spark.range(bits >> _WORD).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = set_bits.unionByName(zero).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    rows = words.groupBy(F.shiftright("word", _BLOCK - _WORD).alias("block")).agg(F.sort_array(F.collect_list(F.struct("word", "bit"))).alias("w"))
    return cut_lineage(rows.select("block", F.transform("w", lambda w: w["bit"]).alias("words")))


def flagged(df: DataFrame, column: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """(row, hit): the rows of ``df``, packed, and whether their id may be in the bitmap;
    null where the id is null."""
    at = _place(column, bits)
    test = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), F.when(df[column].isNotNull(), at).alias("at"))
    test = test.withColumn("block", F.shiftright(F.coalesce("at", F.lit(0)), _BLOCK))
    word = F.get("words", F.shiftright("at", _WORD).bitwiseAND(F.lit((1 << (_BLOCK - _WORD)) - 1)).cast("int"))
    bit = F.expr("cast(at & 63 as int)")
    hit = F.call_function("shiftrightunsigned", word, bit).bitwiseAND(F.lit(1)) == 1
    return test.join(F.broadcast(bitmap), "block").select("row", hit.alias("hit"))


def thinned(df: DataFrame, column: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose id may be in the bitmap, without an exchange of ``df``."""
    return flagged(df, column, bitmap, bits).filter("hit").select("row.*")


def present(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids``, a written table of distinct ids in a column of
    the same name: thinned, then joined exactly."""
    bits = bitmap_bits(ids.count())
    if bits is not None:
        df = thinned(df, column, id_bitmap(ids, column, bits), bits)
    return df.join(ids, column, "left_semi").select(*df.columns)


def absent(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is null or not in ``ids`` (as in ``present``).  Only rows
    whose id may be in ``ids`` meet it in a join; all others pass in the scan's stage."""
    bits = bitmap_bits(ids.count())
    if bits is None:
        return df.join(ids, column, "left_anti").select(*df.columns)
    marked = flagged(df, column, id_bitmap(ids, column, bits), bits)
    maybe = marked.filter("hit").select("row.*").join(ids, column, "left_anti").select(*df.columns)
    return marked.filter("hit IS NULL OR NOT hit").select("row.*").unionByName(maybe)


def worth_thinning(df: DataFrame) -> bool:
    """Whether a stored table is so large (counted from file footers) that its exchange
    costs more than the bitmap's stages."""
    return df.count() >= LEAST_ROWS


def existing(df: DataFrame, column: str, ids: DataFrame, id_column: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in ``ids``, a written table of distinct ids that
    is counted first; a table not ``worth_thinning`` is joined plainly."""
    ids = ids.select(F.col(id_column or column).alias(column))
    return present(df, column, ids) if worth_thinning(df) else df.join(ids, column, "left_semi")
