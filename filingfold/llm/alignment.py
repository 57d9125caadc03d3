"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers split the same bytes; a token is known by where it ends.  The ends of a
text under A and under B are two rising lists, and the shorter drives: each of its ends
is looked for in the longer one by steps that double until they pass it (from where a
nearby earlier end was found), then by halving the last step.  Ends that both lists hold
cut the text into groups; ranks in the two lists, subtracted from group to group, give the
ranges of A and B tokens that share a group's bytes.  All texts of a batch are searched
together, each in its own part of the lists.

Every pair of an A and a B token in one group is a link.  In how many documents a pair of
token ids is linked is counted over the corpus: pairs come out of a task once a document,
are summed per task and then by pair.  The table of pairs grows with the vocabularies and
slowly with the corpus, not with the rows.  It is broadcast to look the pairs of each
document up where it has at most ``BROADCAST_PAIRS`` rows (counted first); a larger one is
joined by pair, behind an exchange of both sides, so a pair in nearly all documents can be
split.

Defined cases: null and empty texts, and texts that a tokenizer doesn't give back byte for
byte, have no tokens: zeros and an empty digest; texts are read whole; equal rows and
repeated or null doc_ids are documents of their own; an empty table gives an empty
result; other columns are left out, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator, Sequence
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import staged, table
from filingfold.llm.textkernel import runs, text_buffers
from filingfold.llm.token_machine import byte_alphabet

A_RANKS, A_TOKENS, B_MODEL = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"
BROADCAST_PAIRS = 1_000_000
#: Drivers that start from the place of one driver found before them.
STRIDE = 32
#: Links of one group that are listed one by one.
LARGE_GROUP = 4096
#: Bits of a B id, and of a pair; what is above them is the text in its run.
B_BITS, PAIR_BITS = 20, 40


def gallop(longer: np.ndarray, wanted: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Place in ``longer`` of the first element not below each ``wanted``, looked for from
    ``start`` on and before ``stop``: steps double, then the last one is halved."""
    low, step = start.copy(), np.ones(len(start), np.int64)
    live = np.flatnonzero(low < stop)
    while len(live):  # longer[low - 1] < wanted; low + step may be past it
        probe = np.minimum(low[live] + step[live], stop[live]) - 1
        short = longer[probe] < wanted[live]
        low[live[short]] = probe[short] + 1
        step[live[short]] *= 2
        live = live[short]
        live = live[low[live] < stop[live]]
    high = np.minimum(low + step, stop)
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) >> 1
        below = longer[middle] < wanted[live]
        low[live[below]] = middle[below] + 1
        high[live[~below]] = middle[~below]
        live = live[low[live] < high[live]]
    return low


def common_ends(a: np.ndarray, a_bounds: np.ndarray, b: np.ndarray, b_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the ends that both lists of a text hold; text i has
    ``a[a_bounds[i]:a_bounds[i + 1]]`` and likewise of ``b``."""
    swap = np.diff(a_bounds) > np.diff(b_bounds)  # the shorter list drives, text by text
    found_a, found_b = [], []
    for some, d, d_bounds, other, o_bounds in ((~swap, a, a_bounds, b, b_bounds), (swap, b, b_bounds, a, a_bounds)):
        texts = np.flatnonzero(some)
        count = np.diff(d_bounds)[texts]
        if not count.sum():
            continue
        text = np.repeat(texts, count)
        place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        driver = d_bounds[text] + place
        head = place % STRIDE == 0
        at = np.empty(len(driver), np.int64)
        at[head] = gallop(other, d[driver[head]], o_bounds[text[head]], o_bounds[text[head] + 1])
        near = at[head][np.cumsum(head) - 1]
        at[~head] = gallop(other, d[driver[~head]], near[~head], o_bounds[text[~head] + 1])
        both = at < o_bounds[text + 1]
        both[both] = other[at[both]] == d[driver[both]]
        (found_a if d is a else found_b).append(driver[both])
        (found_b if d is a else found_a).append(at[both])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


def picked(values: list, places: list[int]) -> Sequence:
    return itemgetter(*places)(values) if len(places) > 1 else [values[i] for i in places]


class Tokenizers:
    """A and B, with the bytes of their tokens.  A has the ids of its byte-level file; its
    merges run by the ranks of the same vocabulary."""

    def __init__(self, files: dict):
        import sentencepiece
        import tiktoken

        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in files["ranks"].splitlines())}
        self.a = tiktoken.Encoding("byte-level", pat_str=files["pattern"], mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files["model"])
        self.a_bytes = files["a_bytes"]
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        #: An id with the sign behind it: A's inside a group and at its end, then B's.
        self.said = [f"{i}{c}" for i in range(len(self.a_bytes)) for c in ",|"] + [f"{i}{c}" for i in range(len(self.b_bytes)) for c in ",;"]

    def encode(self, texts: list[str | None]) -> tuple[list, list]:
        """Ids of each text under A and B; none where either loses a byte."""
        whole = [" " + t if t else "" for t in texts]
        a = self.a.encode_ordinary_batch(whole, num_threads=1)
        b = self.b.encode([t or "" for t in texts], num_threads=1)
        for i, t in enumerate(whole):
            raw = t.encode()
            if b"".join(picked(self.a_bytes, a[i])) != raw or b"".join(picked(self.b_bytes, b[i])) != raw:
                a[i], b[i] = [], []
        return a, b


def read_files(ranks: str, tokens: str, model: str, pattern: str) -> dict:
    """What ``Tokenizers`` needs of the vocabulary files, read by the driver."""
    with open(ranks, encoding="ascii") as f:
        listed = f.read()
    with open(tokens, encoding="utf-8") as f:
        spec = json.load(f)
    with open(model, "rb") as f:
        proto = f.read()
    alphabet = byte_alphabet()
    names = {i: t for t, i in spec["model"]["vocab"].items()}
    return {"ranks": listed, "model": proto, "pattern": pattern, "a_bytes": [bytes(alphabet[c] for c in names[i]) for i in range(len(names))]}


def align(tokenizers: Tokenizers, texts: list[str | None]) -> dict[str, np.ndarray]:
    """Ids and bounds of the texts, places of the common ends, and groups a text."""
    a_lists, b_lists = tokenizers.encode(texts)
    out = {}
    for name, lists, size in (("a", a_lists, tokenizers.a_size), ("b", b_lists, tokenizers.b_size)):
        bounds = np.append(0, np.cumsum([len(x) for x in lists], dtype=np.int64))
        ids = np.fromiter(chain.from_iterable(lists), np.int64, int(bounds[-1]))
        out |= {name: ids, f"{name}_bounds": bounds, f"{name}_ends": np.cumsum(size[ids])}
    at_a, at_b = common_ends(out["a_ends"], out["a_bounds"], out["b_ends"], out["b_bounds"])
    # a group is the tokens since the common end before it; texts end in a common end
    return out | {"stop_a": at_a + 1, "stop_b": at_b + 1, "groups": np.append(0, np.searchsorted(at_a, out["a_bounds"][1:]))}


def widths(x: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of each group: its A and B tokens, and the first of either."""
    wide = [np.diff(x[stop], prepend=0) for stop in ("stop_a", "stop_b")]
    return *wide, *(x[stop] - w for stop, w in zip(("stop_a", "stop_b"), wide, strict=True))


def spelled(tokenizers: Tokenizers, x: dict[str, np.ndarray]) -> list[str]:
    """Groups of each text as a1,a2|b1;a3|b2,b3."""
    wide_a, wide_b, first_a, first_b = widths(x)
    said = np.empty(len(x["a"]) + len(x["b"]), np.int64)  # in the order they are said
    code = 2 * x["a"]
    code[x["stop_a"] - 1] += 1
    said[np.arange(len(code)) + np.repeat(first_b, wide_a)] = code
    code = 2 * (x["b"] + len(tokenizers.a_bytes))
    code[x["stop_b"] - 1] += 1
    said[np.arange(len(code)) + np.repeat(x["stop_a"], wide_b)] = code
    at = (x["a_bounds"] + x["b_bounds"]).tolist()
    said = said.tolist()
    return ["".join(picked(tokenizers.said, said[lo:hi]))[:-1] for lo, hi in zip(at, at[1:], strict=False)]


def links_of(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, bounds, links): the distinct linked pairs of ids of each text (A's id
    stands above ``B_BITS``), how many links each has, where a text's pairs are, and all
    links of each text."""
    wide_a, wide_b, first_a, first_b = widths(x)
    text = np.repeat(np.arange(len(x["groups"]) - 1), np.diff(x["groups"]))
    large = wide_a * wide_b > LARGE_GROUP
    # each A token of a group meets all of the group's B tokens
    group = np.repeat(np.arange(len(wide_a)), wide_a)
    times = np.where(large, 0, wide_b)[group]
    b = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - first_b[group], times)
    links = [np.repeat((text[group] << PAIR_BITS) | (x["a"] << B_BITS), times) | x["b"][b]]
    weights = [np.ones(len(b), np.int64)]
    for g in np.flatnonzero(large):  # by distinct ids, however often they repeat
        own_a, n_a = np.unique(x["a"][first_a[g] : first_a[g] + wide_a[g]], return_counts=True)
        own_b, n_b = np.unique(x["b"][first_b[g] : first_b[g] + wide_b[g]], return_counts=True)
        links.append(((text[g] << PAIR_BITS) | (own_a[:, None] << B_BITS) | own_b).reshape(-1))
        weights.append((n_a[:, None] * n_b).reshape(-1))
    links, weights = np.concatenate(links), np.concatenate(weights)
    order = np.argsort(links)
    links, weights = links[order], weights[order]
    new = np.ones(len(links), bool)
    new[1:] = links[1:] != links[:-1]
    pairs = links[new]
    bounds = np.searchsorted(pairs, np.arange(len(x["groups"])) << PAIR_BITS)
    every = np.append(0, np.cumsum(wide_a * wide_b))[x["groups"]]
    return pairs & ((1 << PAIR_BITS) - 1), np.add.reduceat(weights, np.flatnonzero(new)) if len(links) else weights, bounds, np.diff(every)


def _aligned(files):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(files.value)
        for batch in batches:
            _, offsets = text_buffers(batch["text"])
            for lo, hi in runs(offsets):
                x = align(tokenizers, batch["text"].slice(lo, hi - lo).to_pylist())
                pairs, times, at, n_links = links_of(x)
                at = pa.array(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo), pa.array(np.diff(x["a_bounds"])), pa.array(np.diff(x["b_bounds"])),
                        pa.array(np.diff(x["groups"]).astype(np.int64)), pa.array(n_links),
                        pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled(tokenizers, x)]),
                        pa.ListArray.from_arrays(at, pa.array(pairs)),
                        pa.ListArray.from_arrays(at, pa.array(times)),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    return run


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def aligned(docs: DataFrame, files: dict) -> DataFrame:
    """Each document with its token, group and link counts, the digest of its groups, and
    its distinct linked id pairs (``a << 20 | b``) with the number of their links."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_aligned(docs.sparkSession.sparkContext.broadcast(files)), ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each pair linked, and whether no pair of the
    same A id is in more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counts, "pairs")
    top = counts.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("n").alias("top"))
    joined = counts.withColumn("a", F.shiftright("pair", B_BITS)).join(top, "a")
    return joined.select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def op13_galloping_alignment(
    spark: SparkSession, sf_dir: str, paths: tuple[str, str, str] | None = None, pattern: str | None = None, most: int = BROADCAST_PAIRS
) -> DataFrame:
    if paths is None or pattern is None:
        import public_tokenizers

        paths = paths or tuple(public_tokenizers.path(f) for f in (A_RANKS, A_TOKENS, B_MODEL))
        pattern = pattern or public_tokenizers.PATTERN
    rows = aligned(table(spark, sf_dir, "documents"), read_files(*paths, pattern))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = staged(pair_counts(rows), "counts")
    small = counts.count() <= most
    linked = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    of_row = (
        linked.join(F.broadcast(counts) if small else counts, "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    )
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(of_row, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
