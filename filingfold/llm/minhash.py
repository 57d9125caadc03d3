"""Near-duplicate documents by circulant MinHash, banding and exact verification.

Signatures (Li and Li, C-MinHash).  The universe is the 2^32 hash values of shingles.
A first permutation sigma scatters a document's shingles over it; coordinate j is the
smallest value of a second permutation pi, shifted circularly by j:
``min(pi(sigma(s) + j))``.  Both are bijections of 32-bit words (odd multiplications
and xor-shifts), so two permutations give all coordinates.

Candidates.  ``rows`` coordinates make a band; equal bands make a bucket.  With the
defaults (40 bands of 6) a pair at similarity 0.85 shares no bucket with probability
6e-9, at 0.8 with 5e-6.

Links without all pairs.  Documents with equal shingle sets are one node.  In each
round every bucket that still holds more than one component compares a few pivots
with its other members (never two of one component, never a pair twice, and only
sizes that can meet the threshold); a pivot that has met its whole bucket leaves it.
The first pivot of a bucket is the member whose buckets are largest, which in a
group of edited copies is the original; later rounds draw more by hash, 32 times as
many each round.  In the second round pairs that share a rare shingle are listed from an
inverted index (``_narrow``); a node's common shingles bound what it can share with
any other, and nodes and pairs whose bound misses the threshold are not compared.
Copies thus cost a row per member.  Every candidate pair ends up verified
on full sets, inside one component, or excluded by an exact bound, so no link is lost
to the scheme.

Components come from alternating large-star and small-star steps; nothing is
collected but counts.

Defined cases: a null or empty text has an empty set and links with nothing; a text
with fewer words than a shingle is one shingle; a null doc_id links with nothing, is
kept and has a null component; rows that repeat a doc_id are one node with the links
of all its texts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import staged, table
from filingfold.llm.textkernel import Words, mix64, runs, shingles, text_buffers
from filingfold.operators.prefilter import absent, present

BANDS, ROWS = 40, 6
RARE = 16
SHIFT_COLUMNS = 512
#: About how many pivots of a bucket lie in one row.
PIVOT_RUN = 1024
#: pi and sigma: odd multipliers of the two permutations, fixed so that reruns agree.
SIGMA = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
PI = (np.uint32(0x9E3779B1), np.uint32(0x27D4EB2F))


def permute(x: np.ndarray, odd: tuple[np.uint32, np.uint32]) -> np.ndarray:
    """A bijection of 32-bit words, in place."""
    x *= odd[0]
    x ^= x >> np.uint32(15)
    x *= odd[1]
    x ^= x >> np.uint32(13)
    return x


def signature(sets: np.ndarray, size: int) -> np.ndarray:
    """The first ``size`` circulant coordinates of a set of 64-bit shingle hashes."""
    place = permute((sets >> np.uint64(32)).astype(np.uint32), SIGMA)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(place), SHIFT_COLUMNS):
        least = np.minimum(least, permute(place[None, at : at + SHIFT_COLUMNS] + shifts, PI).min(axis=1))
    return least


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) bucket keys of (n, bands * rows) signatures; the band's number is
    part of the key."""
    parts = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    for r in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def _fingerprints(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for lo, hi in runs(offsets):
                words = Words(data, offsets[lo : hi + 1])
                n = np.zeros(hi - lo, np.int64)
                digest = np.zeros((hi - lo, 2), np.uint64)
                sig = np.zeros((hi - lo, bands * rows), np.uint32)
                for i in range(hi - lo):
                    own = np.unique(shingles(words.hash[words.bounds[i] : words.bounds[i + 1]], k))
                    n[i] = len(own)
                    if len(own):
                        digest[i] = mix64(own).sum(), mix64(own ^ np.uint64(0x5851F42D4C957F2D)).sum()
                        sig[i] = signature(own, bands * rows)
                keys = pa.array(band_keys(sig, bands, rows).reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo), pa.array(n), pa.array(digest[:, 0].view(np.int64)),
                        pa.array(digest[:, 1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * bands, bands, dtype=np.int32)), keys),
                    ],
                    names=["doc_id", "n", "d1", "d2", "keys"],
                )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for lo, hi in runs(offsets):
                words = Words(data, offsets[lo : hi + 1])
                own = [np.unique(shingles(words.hash[words.bounds[i] : words.bounds[i + 1]], k)) for i in range(hi - lo)]
                at = np.cumsum([0, *map(len, own)]).astype(np.int32)
                values = pa.array(np.concatenate(own).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(at), values)], names=["id", "set"]
                )

    return run


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node points to one root, and no root points on."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("root"))
    ends = ends.unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("root")))
    counts = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    return counts.filter("out > 1 OR (out = 1 AND root = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of ``edges`` (a, b): the least id that is reachable.

    Large-star and small-star steps (Kiveris et al. 2014) until the edges are stars.
    Minima are combined before the shuffle and staged, so that in the join behind
    both sides come from an exchange and AQE can split a hub."""

    def star(links: DataFrame, small: bool) -> DataFrame:
        both = links if small else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # small: a > b, the lesser neighbours of a.  large: all neighbours of a.
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        moved = both.join(least, "a")
        if small:
            out = moved.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                                 F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        else:
            out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return staged(out.filter("a <> b").distinct(), "edges")

    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while not _are_stars(edges):
        edges = star(star(edges, small=False), small=True)
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def fingerprints(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n, d1, d2, keys): size and 128-bit digest of the shingle set, bucket keys."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_fingerprints(k, bands, rows), "doc_id long, n long, d1 long, d2 long, keys array<long>")


def _open(live: DataFrame, percent: int) -> DataFrame:
    """Rows of the buckets that hold more than one component, without those that
    cannot link there: the intersection with a partner is at most ``s`` and must reach
    percent / (100 + percent) of both sizes, and no partner is smaller than the
    bucket's smallest member or than the threshold allows."""
    state = live.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("n").alias("least"))
    state = staged(state.filter("lo <> hi").select("bucket", "least"), "open-buckets")
    partner = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    return live.join(state, "bucket").filter(F.col("s") * (100 + percent) >= (F.col("n") + partner) * percent).drop("least")


def _narrow(live: DataFrame, sets: DataFrame, percent: int, repeated: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Splits what is left by rare shingles, those in at most ``RARE`` open nodes.

    Pairs that share a rare shingle are listed from an inverted index, at most
    RARE^2 / 2 for a shingle.  All other pairs share only common shingles, so ``s``,
    a node's number of common shingles, bounds their intersection.  Returns ``live``
    with that ``s``, and the listed pairs (a, b).  A doc_id of ``repeated`` may have several
    sets, of which ``live`` has only the sizes: its ``s`` holds for each set of the size."""
    nodes = live.select("id", "label").distinct()
    which = F.lit(0) if repeated is None else F.xxhash64("set")
    each = sets.join(nodes, "id").select("id", "label", F.size("set").cast("long").alias("n"), which.alias("which"), F.explode("set").alias("shingle"))
    rare = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") <= RARE)
    held = staged(each.join(staged(rare, "rare"), "shingle"), "held")
    own = held.groupBy("id", "n", "which").agg(F.count(F.lit(1)).alias("own"))
    if repeated is not None:
        # The least over the sets of a size; a set without a rare shingle makes it none.
        several = sets.join(repeated, sets["id"] == repeated["doc_id"], "left_semi").groupBy("id", F.size("set").cast("long").alias("n"))
        own = own.groupBy("id", "n").agg(F.min("own").alias("own"), F.count(F.lit(1)).alias("with"))
        own = own.join(several.agg(F.count(F.lit(1)).alias("all")), ["id", "n"], "left").filter(F.col("with") >= F.coalesce("all", F.lit(1)))
    own = staged(own.select("id", "n", "own"), "own")
    left = held.filter("df > 1").select("shingle", "id", "n", "label")
    right = left.select("shingle", F.col("id").alias("p"), F.col("n").alias("pn"), F.col("label").alias("pl"))
    near = F.least("n", "pn") * 100 >= F.greatest("n", "pn") * percent
    listed = left.join(right, "shingle").filter((F.col("id") < F.col("p")) & (F.col("label") != F.col("pl")) & near)
    out = live.drop("s").join(own, ["id", "n"], "left").withColumn("s", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")
    return out, listed.select(F.col("id").alias("a"), F.col("p").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``: documents with
    Jaccard similarity of ``k``-word shingles of at least ``percent`` / 100 are linked."""
    prints = staged(fingerprints(docs, k, bands, rows), "fingerprints")
    real = prints.filter("n > 0 AND doc_id IS NOT NULL")
    nodes = staged(
        real.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("id"), F.min_by("keys", "doc_id").alias("keys")), "nodes"
    )
    filed = nodes.select("id", "n", F.explode("keys").alias("bucket"))
    sizes = filed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    shared = staged(sizes.filter("lo <> hi").select("bucket", "size"), "shared")
    members = staged(filed.join(shared, "bucket"), "members")
    weight = members.groupBy("id").agg(F.sum("size").alias("weight"))
    members = staged(members.join(weight, "id").select("bucket", "id", "n", "weight", F.col("n").alias("s")), "members")
    labels = tested = sets = repeated = None
    narrowed, pivots = False, 1
    members = members.withColumn("label", F.col("id"))
    linked = False
    while True:
        if linked:
            named = members.drop("label").join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
            members = staged(named, "live")
        # At first every shared bucket is open, and every member may link.
        live = members if tested is None else staged(_open(members, percent), "open")
        if live.isEmpty():
            break
        listed = None
        if tested is not None and not narrowed:
            narrowed = True
            live, listed = _narrow(live, sets, percent, repeated)
            live = staged(_open(staged(live, "narrowed"), percent), "open")
        state = staged(
            live.groupBy("bucket").agg(F.count(F.lit(1)).alias("left"), F.max_by("id", F.struct("weight", -F.col("id"))).alias("first")), "open-buckets"
        )
        drawn = F.pmod(F.xxhash64(F.lit(pivots), "bucket", "id"), F.lit(1 << 30)) * F.col("left") < F.lit(pivots << 30)
        live = staged(
            live.join(state, "bucket").withColumn("pivot", (F.col("id") == F.col("first")) | (drawn if pivots > 1 else F.lit(False))).drop("left", "first"),
            "open",
        )
        # One row a bucket and run of pivots, so the join makes a row for each member, bucket
        # and run; a member's pivots are made distinct over its buckets before they are listed.
        end = F.struct(F.col("id").alias("p"), F.col("n").alias("pn"), F.col("s").alias("ps"), F.col("label").alias("pl"))
        ends = live.filter("pivot").groupBy("bucket", F.pmod(F.xxhash64("id"), F.lit(max(1, pivots // PIVOT_RUN))).alias("run"))
        ends = staged(ends.agg(F.collect_list(end).alias("ends")).select("bucket", "ends"), "pivots")
        # The intersection is at most the smaller support; it must reach the threshold.
        may = lambda x: (F.col("label") != x["pl"]) & (F.least(F.col("s"), x["ps"]) * (100 + percent) >= (F.col("n") + x["pn"]) * percent)
        met = live.join(ends, "bucket").select("id", F.transform(F.filter("ends", may), lambda x: x["p"]).alias("ps")).filter(F.size("ps") > 0)
        met = met.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("ps"))).alias("ps")).select("id", F.explode("ps").alias("p"))
        pairs = met.select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b"))
        pairs = (pairs if listed is None else pairs.unionByName(listed)).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        if sets is None:
            # Full sets of the documents that share a bucket with another one.
            wanted = members.select(F.col("id").alias("doc_id")).distinct()
            texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            made = lambda rows: rows.mapInArrow(_sets(k), "id long, set array<long>")
            repeated = staged(real.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1).select("doc_id"), "repeated")
            texts = present(texts, "doc_id", staged(wanted, "wanted"))
            if repeated.isEmpty():
                sets, repeated = staged(made(texts), "sets"), None
            else:
                # A set of a repeated doc_id stands once, so that counts over sets are counts of sets.
                once, again = texts.join(repeated, "doc_id", "left_anti"), texts.join(repeated, "doc_id", "left_semi")
                sets = staged(made(once).unionByName(made(again).distinct()), "sets")
        common = F.size(F.array_intersect("sa", "sb"))
        found = staged(
            pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
            .select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb") - common).alias("whole"))
            .filter(F.col("common").cast("long") * 100 >= F.col("whole").cast("long") * percent).select("a", "b"),
            "links",
        )
        linked = not found.isEmpty()
        if linked:
            # The components so far are stars; new links join them.
            stars = found if labels is None else found.unionByName(labels.select(F.col("id").alias("a"), F.col("component").alias("b")))
            labels = components(stars)
        members = live.filter(~F.col("pivot")).drop("pivot")
        pivots *= 32
    groups = nodes.select("d1", "d2", "n", "id")
    if labels is not None:
        groups = groups.join(labels, "id", "left").withColumn("id", F.coalesce("component", "id")).drop("component")
    groups = staged(groups, "groups")
    linked = real.select("doc_id", "d1", "d2", "n").join(groups, ["d1", "d2", "n"]).select("doc_id", "n", F.col("id").alias("component_id"))
    alone = prints.filter("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumnRenamed("n", "n_shingles")


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the least doc_id; rows
    without a doc_id stay, rows that repeat the kept doc_id stay together."""
    found = near_duplicates(docs, k, percent)
    copies = staged(found.filter("doc_id <> component_id").select("doc_id").distinct(), "copies")
    return absent(docs, "doc_id", copies)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


# Exact Jaccard of all pairs that share a shingle, then reachability.
OP1_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), placed AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs
), shingles AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, n, i, w || coalesce(' ' || lead(w) OVER along, '') || coalesce(' ' || lead(w, 2) OVER along, '') AS shingle
    FROM placed WINDOW along AS (PARTITION BY doc_id ORDER BY i)
  ) WHERE i <= greatest(n - 2, 1)
), sized AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sized s ON a = s.doc_id JOIN sized t ON b = t.doc_id
  WHERE 100 * k >= 85 * (s.n + t.n - k)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM docs d LEFT JOIN sized s USING (doc_id) JOIN least c USING (doc_id)
"""
