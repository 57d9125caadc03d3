"""Benchmark decontamination on canonical templates.

Words are lower-cased runs of letters and digits (everything outside ASCII counts as
a letter).  Variable words become typed placeholders: numbers ``<num>``, a unit right
after a number ``<unit>``, capitalised words inside a sentence ``<name>``.  Windows of
``WINDOW`` canonical words are hashed; a hash join finds the windows that a document
shares with benchmark items, and slot values (what stood where the placeholder is)
travel along.

A document is contaminated by an item when it holds at least ``SHARE`` of the item's
distinct windows and the slots are consistent: along one alignment, equal values of
the item must correspond to equal values of the document for at least ``SHARE`` of
the slots.  A question with new numbers or names is thus caught (``reparameterised``),
a chance match of placeholders is not.  Windows with fewer than ``LITERALS`` ordinary
words say nothing and are left out, unless an item has no others; then its words must
stand in the document as they are.  An item shorter than a window is one window, and is
looked for in windows of its length.  An item's first word, which opens a sentence there,
may be a name or a unit by the words before it in a document; such windows are also
compared with that word as it is.

The benchmark's windows are filtered for inside the scan of the documents when they
are at most ``FILTER_WINDOWS`` (checked by a count); beyond that every document window
goes to the same hash join.

Defined cases: a null or empty text has no windows and is clean; an item without
words is ignored; rows equal in doc_id and text share one result; repeated item_ids
are joined as one item with the windows of all its texts; an empty table of either
kind leaves every document clean; other columns pass through ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filingfold.llm.common import staged, table
from filingfold.llm.textkernel import ALNUM, Words, combine, runs, text_buffers

WINDOW = 5
SHARE = 0.8
LITERALS = 3
FILTER_WINDOWS = 1_000_000
KEY = ["k1", "k2"]

# Unit words that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr day days week weeks month months year years "
    "second seconds minute minutes hour hours meter meters metre metres mile miles inch inches foot feet "
    "gram grams kilogram kilograms pound pounds liter liters litre litres dollar dollars euro euros cent cents "
    "percent degree degrees kmh mph hz khz mhz ghz kb mb gb tb w kw v"
).split()

_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2E, 0x21, 0x3F, 0x3A, 0x0A, 0x0D]] = True  # . ! ? : and line ends
_NUM, _UNIT, _NAME = (np.uint64(x) for x in (0x1111111111111111, 0x2222222222222222, 0x3333333333333333))


def _unit_hashes() -> np.ndarray:
    text = " ".join(UNITS).encode()
    return np.sort(Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ALNUM).hash)


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a run of texts, the hash of each word's canonical form, and whether it
    is a placeholder."""
    words = Words(data, offsets, ALNUM)
    n = len(words.start)
    if not n:
        return words, words.hash, np.zeros(0, bool)
    raw = data[int(offsets[0]) : int(offsets[-1])]
    digits = np.concatenate([[0], np.cumsum(_DIGIT[raw])])
    number = digits[words.end] > digits[words.start]
    first = np.zeros(n, bool)
    begins = words.bounds[:-1]
    first[begins[begins < words.bounds[1:]]] = True
    units = _unit_hashes()
    at = np.minimum(np.searchsorted(units, words.hash), len(units) - 1)
    unit = (units[at] == words.hash) & ~first & ~number
    unit[1:] &= number[:-1]
    unit[0] = False
    # A name: capital first letter, no other capital, not the first word of a sentence.
    capitals = np.concatenate([[0], np.cumsum(_UPPER[raw])])
    stops = np.concatenate([[0], np.cumsum(_STOP[raw])])
    name = _UPPER[raw[words.start]] & (capitals[words.end] - capitals[words.start] == 1) & (words.end - words.start > 1)
    opened = np.ones(n, bool)
    opened[1:] = stops[words.start[1:]] > stops[words.end[:-1]]
    name &= ~(first | opened | number | unit)
    shape = words.hash.copy()
    shape[number], shape[unit], shape[name] = _NUM, _UNIT, _NAME
    return words, shape, number | unit | name


class Wanted:
    """A set of window hashes; most others fall to a table of their low 16 bits."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.sort(hashes)
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.sorted & np.uint64(0xFFFF)).astype(np.int64)] = True

    def among(self, hashes: np.ndarray) -> np.ndarray:
        out = self.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
        some = np.flatnonzero(out)
        if len(some):
            at = np.minimum(np.searchsorted(self.sorted, hashes[some]), len(self.sorted) - 1)
            out[some] = self.sorted[at] == hashes[some]
        return out


def _find(data: np.ndarray, offsets: np.ndarray, wanted: Wanted | None, lengths: list[int] | None) -> Iterator[tuple]:
    """(length, text, place, window hash, slot counts, slot values, flag) of the windows of
    a run, in arrays by length.  Of items (no ``lengths``) those of WINDOW words, or the
    whole shorter text, flagged where the item has no window that tells something; of
    documents those of all ``lengths``, and flagged once more those that start with a name
    or unit, with that word as it is."""
    items = lengths is None
    words, shape, slot = canonical(data, offsets)
    size = np.diff(words.bounds)
    owner = np.repeat(np.arange(len(size)), size)
    values = words.hash.view(np.int64)
    filled = np.concatenate([[0], np.cumsum(slot)])
    for k in range(WINDOW, 0, -1) if items else lengths:
        if items and k < WINDOW:
            at = words.bounds[:-1][size == k]
        else:
            at = np.arange(max(0, len(owner) - k + 1))
            at = at[owner[at] == owner[at + k - 1]] if len(at) else at
        hashes = combine([shape[at + j] for j in range(k)])
        flag = np.zeros(len(at), bool)
        if items:
            good = k - (filled[at + k] - filled[at]) >= min(LITERALS, k)
            flag = (np.bincount(owner[at], good, len(size)) == 0)[owner[at]]  # items with no such window keep all
            good |= flag
        else:
            good = wanted.among(hashes) if wanted is not None else np.ones(len(at), bool)
        found = [(at[good], hashes[good], flag[good], 0)]
        if not items:
            at = at[(shape[at] == _NAME) | (shape[at] == _UNIT)]
            hashes = combine([words.hash[at], *(shape[at + j] for j in range(1, k))])
            good = wanted.among(hashes) if wanted is not None else np.ones(len(at), bool)
            found.append((at[good], hashes[good], np.ones(int(good.sum()), bool), 1))
        for at, hashes, flag, skip in found:
            if len(at):
                around = (at[:, None] + np.arange(skip, k)).ravel()
                counts = filled[at + k] - filled[at + skip]
                yield k, owner[at], at - words.bounds[owner[at]], hashes, counts, values[around[slot[around]]], flag


def _windows(keys: list[str], wanted: Wanted | None, lengths: list[int] | None):
    """Rows (keys, window, place, slots, flag, length) of the windows of each text: those
    that are wanted, or for items those that tell something, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for lo, hi in runs(offsets):
                for k, text, place, hashes, counts, values, flag in _find(data, offsets[lo : hi + 1], wanted, lengths):
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    row = pa.array(text + lo)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch[c].take(row) for c in keys), pa.array(hashes.view(np.int64)), pa.array(place),
                            pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), pa.array(flag), pa.array(np.full(len(text), k, np.int32)),
                        ],
                        names=[*keys, "window", "place", "slots", "flag", "length"],
                    )

    return run


def _candidates(found: DataFrame, one: DataFrame, sizes: DataFrame, share: float) -> DataFrame:
    """Distinct (k1, k2, item_id) that share one of the item's rarest windows.  A document
    that holds ``share`` of n windows holds one of any ``n - ceil(share n) + 1`` of them;
    the ones with the fewest hits in the documents are taken, so a phrase that many items
    and many documents share makes no pairs unless an item has little else."""
    words = F.xxhash64("window", "slots")
    bare = not one.filter("as_is").isEmpty()
    seen = found.groupBy(F.col("window").alias("part")).agg(F.count(F.lit(1)).alias("hits"))
    if bare:
        seen = seen.unionByName(found.groupBy(words.alias("part")).agg(F.count(F.lit(1)).alias("hits")))
    seen = seen.groupBy("part").agg(F.sum("hits").alias("hits"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("hits", "part"))
    least = F.ceil(F.lit(share) * F.col("n_windows") - 1e-9)
    rare = (
        one.select("item_id", "part").distinct().join(seen, "part", "left").fillna(0, ["hits"])
        .join(sizes, "item_id").withColumn("rank", rank)
        .filter((F.col("hits") > 0) & (F.col("rank") <= F.col("n_windows") - least + 1)).select("item_id", "part")
    )
    probes = staged(one.distinct().join(rare, ["item_id", "part"], "left_semi"), "rare-windows")
    pairs = found.join(probes.filter("NOT as_is").select("item_id", "window"), "window").select(*KEY, "item_id")
    if bare:
        own = probes.filter("as_is").select("item_id", "window", F.col("item_slots").alias("slots"))
        pairs = pairs.unionByName(found.join(own, ["window", "slots"]).select(*KEY, "item_id"))
    return pairs.distinct()


def contaminations(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(k1, k2, item_id, containment, consistency, reparameterised) of each document
    (by ``keyed``) and item that contaminates it."""
    spark = docs.sparkSession
    items = staged(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
        .mapInArrow(_windows(["item_id"], None, None), "item_id long, window long, place long, slots array<long>, flag boolean, length int"),
        "item-windows",
    )
    # What counts as one window of an item: the template, or the words as they are.
    part = F.when(F.col("flag"), F.xxhash64("window", "slots")).otherwise(F.col("window")).alias("part")
    sizes = items.select("item_id", part).groupBy("item_id").agg(F.count_distinct("part").alias("n_windows"))
    known = items.select("window").distinct()
    short = items.filter(F.col("length") < WINDOW).select("length").distinct().collect()  # at most WINDOW - 1
    lengths = [WINDOW, *sorted((r["length"] for r in short), reverse=True)]
    wanted = None
    if known.count() <= FILTER_WINDOWS:
        wanted = Wanted(known.toPandas()["window"].to_numpy(np.int64).view(np.uint64))  # at most 8 MB
    found = docs.select(*KEY, F.col("text").cast("string").alias("text")).mapInArrow(
        _windows(KEY, wanted, lengths), "k1 long, k2 long, window long, place long, slots array<long>, flag boolean, length int"
    )
    found = found.withColumnRenamed("flag", "first").drop("length")
    if wanted is None:
        found = found.join(known, "window", "left_semi")
    found = staged(found.dropDuplicates([*KEY, "window", "place"]), "hits")
    one = items.select("item_id", "window", part, F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), F.col("flag").alias("as_is"))
    pairs = staged(_candidates(found, one.select("item_id", "window", "part", "item_slots", "as_is"), sizes, share), "candidates")
    # Windows with the first word as it is are for the start of an item; items whose words
    # must stand as they are meet by the values of their slots, too.
    met = staged(
        pairs.join(one, "item_id").join(found, [*KEY, "window"])
        .filter("(NOT first OR item_place = 0) AND (NOT as_is OR slots = item_slots)")
        .select(*KEY, "item_id", "part", (F.col("place") - F.col("item_place")).alias("shift"), "slots", "item_slots"),
        "met",
    )
    held = (
        met.select(*KEY, "item_id", "part").distinct().groupBy(*KEY, "item_id").agg(F.count(F.lit(1)).alias("n"))
        .join(sizes, "item_id").withColumn("containment", F.col("n") / F.col("n_windows"))
        .filter(F.col("containment") >= share).select(*KEY, "item_id", "containment")
    )
    # Slots by alignment: how often an item's value meets its most frequent counterpart.
    met_slots = (
        met.select(*KEY, "item_id", "shift", F.explode(F.arrays_zip("item_slots", "slots")).alias("s"))
        .groupBy(*KEY, "item_id", "shift", "s.item_slots", "s.slots").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*KEY, "item_id", "shift", "item_slots")
        .agg(F.max("n").alias("best"), F.sum("n").alias("all"), F.sum(F.when(F.col("item_slots") == F.col("slots"), F.col("n")).otherwise(0)).alias("same"))
        .groupBy(*KEY, "item_id").agg(F.sum("best").alias("best"), F.sum("all").alias("all"), F.sum("same").alias("same"))
    )
    return (
        held.join(met_slots, [*KEY, "item_id"], "left")
        .withColumn("consistency", F.coalesce(F.col("best") / F.col("all"), F.lit(1.0)))
        .filter(F.col("consistency") >= share)
        .select(*KEY, "item_id", "containment", "consistency", F.coalesce(F.col("same") < F.col("all"), F.lit(False)).alias("reparameterised"))
    )


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a 128-bit key of (doc_id, text)."""
    return docs.withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64(F.lit(1), "text", "doc_id"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` without the contaminated documents."""
    packed = keyed(docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("row"))).select("row", "doc_id", "text", *KEY)
    bad = staged(contaminations(packed.select(*KEY, "text"), benchmark, share).select(*KEY).distinct(), "contaminated")
    return packed.select("row", *KEY).join(bad, KEY, "left_anti").select("row.*")


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = contaminations(docs, table(spark, sf_dir, "benchmark"))
    by_doc = staged(
        found.groupBy(*KEY).agg(
            F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("containment").alias("containment"),
            F.max("reparameterised").alias("reparameterised"),
        ),
        "by-document",
    )
    return docs.select("doc_id", *KEY).join(by_doc, KEY, "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"),
    )
