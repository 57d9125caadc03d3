"""Periodic run detection: online dyadic square catching over the words of a text.

A run is a maximal stretch of words with smallest period q (words q apart are
identical) that holds a square, two equal halves of q words.  ``SquareCatcher`` reads
words as they come.  Whenever a block of 2^k words is complete (at a multiple of 2^k),
a catcher watches from it for periods of 2^(k+1) - 1 to 2^(k+2) - 2 words: each of these
periods fits a whole block into the first half of any square, and the block stands
again one period later.  An appended word ends a new suffix of 2^k words, which is
compared with the blocks whose watch it falls into (one 64-bit hash per suffix and
level, each made of two of the level below).  Equal pairs that follow one another are
one catch; it is carried left by comparing ever shorter suffixes and right as words are
appended, and every catch that has become a square is a run.  Catches of the same
stretch merge, and so do multiples of a period, which share both ends with it.  A text
of n words takes O(n log n) comparisons, all of one level together.

Several texts may follow one another in one catcher, parted by marks that equal
nothing, so a whole batch costs a few array operations a level.

Defined cases: null, empty and blank texts have no words, no runs and an empty
collapsed text; a null doc_id is passed through and nothing is planted for it; equal
rows give equal results, a row for each; texts of any length are read whole; an empty
table gives an empty result; other columns are left out, whatever their names.  Words
are told apart by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import table
from filingfold.llm.textkernel import Words, combine, mix64, runs, text_buffers

LEAST_LENGTH = 12
SLAB = 1 << 22
#: Words gathered at once when a collapsed text is put together.
GATHER = 1 << 17
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SquareCatcher:
    """Runs of a growing sequence of 64-bit words.  ``longest`` bounds the distance of
    two words in one run where it is known (the longest text of a batch)."""

    def __init__(self, longest: int | None = None):
        self.longest = longest
        self.level = [np.zeros(0, np.uint64)]
        self.n = 0
        #: Catches (period, first, behind): words first..behind-1 equal those a period on.
        self.caught = np.zeros((0, 3), np.int64)

    def append(self, words: np.ndarray) -> None:
        before, self.n = self.n, self.n + len(words)
        self.level[0] = np.concatenate([self.level[0], words.astype(np.uint64)])
        self._advance(before)
        span = self.n if self.longest is None else min(self.n, self.longest)
        k = 0
        while (3 << k) - 1 <= span:  # a block and its copy fit, the level's least period apart
            self._complete(k)
            self._keep(self._catch(k, before))
            k += 1

    def runs(self, least: int = LEAST_LENGTH) -> np.ndarray:
        """(first word, word behind, period) of each run so far, by first word, then period."""
        period, first, behind = self.caught.T
        end = behind + period
        square = (behind - first >= period) & (end - first >= least)
        word = self.level[0]
        left = square & (first > 0)
        left[left] = word[first[left] - 1] == word[first[left] - 1 + period[left]]
        period, first, end = (x[square & ~left] for x in (period, first, end))
        order = np.lexsort((period, end, first))
        period, first, end = period[order], first[order], end[order]
        least_of_stretch = np.ones(len(period), bool)
        least_of_stretch[1:] = (first[1:] != first[:-1]) | (end[1:] != end[:-1])
        out = np.stack([first, end, period], 1)[least_of_stretch]
        return out[np.lexsort((out[:, 2], out[:, 0]))]

    def _complete(self, k: int) -> None:
        """Hashes of the suffixes of 2^k words that the appended words end."""
        if k == len(self.level):
            self.level.append(np.zeros(0, np.uint64))
        if k:
            have, half, below = len(self.level[k]), 1 << (k - 1), self.level[k - 1]
            new = combine([below[have : max(have, len(below) - half)], below[have + half :]])
            self.level[k] = np.concatenate([self.level[k], new])

    def _catch(self, k: int, before: int) -> np.ndarray:
        """Catches of level k whose second copy ends in an appended word."""
        size, h, found = 1 << k, self.level[k], []
        low, wide = 2 * size - 1, 2 * size
        first = max(0, (before - 5 * size + 2) // size * size)
        blocks = np.arange(first, max(first, len(h) - low), size)
        padded = np.concatenate([h[first:], np.zeros(4 * size, np.uint64)])
        watch = sliding_window_view(padded[low:], wide)[::size][: len(blocks)]
        rows = max(1, SLAB // wide)
        known = self._reach()
        for at in range(0, len(blocks), rows):
            some = blocks[at : at + rows]
            b, o = np.nonzero(watch[at : at + rows] == h[some][:, None])
            s, p = some[b], low + o
            copy = s + p + size
            new = (copy <= self.n) & (copy > before)
            s, p = s[new], p[new]
            if known is not None and len(s):  # a multiple of a known run's period
                start, end, period = known
                i = np.searchsorted(start, s, side="right") - 1
                inside = (i >= 0) & (end[i] >= s + p + size) & (p % period[i] == 0)
                s, p = s[~inside], p[~inside]
            found.append(np.stack([p, s], 1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        if not len(pairs):
            return np.zeros((0, 3), np.int64)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        p, s = pairs.T
        chain = np.ones(len(p), bool)
        chain[1:] = (p[1:] != p[:-1]) | (s[1:] - s[:-1] != size)
        last = np.append(chain[1:], True)
        p, left, right = p[chain], s[chain], s[last] + size
        for j in range(k - 1, -1, -1):
            step, hj = 1 << j, self.level[j]
            ok = left >= step
            ok[ok] = hj[left[ok] - step] == hj[left[ok] - step + p[ok]]
            left = left - step * ok
        return np.stack([p, left, self._carry(p, right, k)], 1)

    def _carry(self, p: np.ndarray, right: np.ndarray, k: int) -> np.ndarray:
        """How far words from ``right`` on equal those ``p`` further on."""
        live = np.arange(len(p))
        while len(live):
            for j in range(min(k, len(self.level) - 1), -1, -1):
                step, hj = 1 << j, self.level[j]
                ok = right[live] + p[live] + step <= self.n
                at = right[live[ok]]
                ok[ok] = hj[at] == hj[at + p[live[ok]]]
                right[live[ok]] += step
                if j == min(k, len(self.level) - 1):
                    again = live[ok]
            live = again
        return right

    def _advance(self, before: int) -> None:
        """Catches that reach the end of the words so far go on into the new ones; the
        others are over and stay only if they have become squares."""
        period, first, behind = self.caught.T
        self.caught = self.caught[(behind - first >= period) | (behind + period == before)]
        period, _, behind = self.caught.T
        live = behind + period == before
        for k in range(1, len(self.level)):
            self._complete(k)
        self.caught[live, 2] = self._carry(period[live], behind[live].copy(), len(self.level) - 1)

    def _keep(self, new: np.ndarray) -> None:
        """Merge: a catch inside another of the same period adds nothing."""
        if not len(new):
            return
        every = np.concatenate([self.caught, new])
        period, first, behind = every.T
        live = (behind - first >= period) | (behind + period == self.n)
        every = every[live]
        every = every[np.lexsort((-every[:, 2], every[:, 1], every[:, 0]))]
        period, _, behind = every.T
        far = period * (self.n + 1) + behind
        reach = np.maximum.accumulate(far)
        keep = np.ones(len(every), bool)
        keep[1:] = far[1:] > reach[:-1]
        self.caught = every[keep]

    def _reach(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Runs so far by first word: for each, of those up to it the one that ends last."""
        period, first, behind = self.caught.T
        square = behind - first >= period
        if not square.any():
            return None
        period, first, end = period[square], first[square], (behind + period)[square]
        order = np.lexsort((period, first))
        period, first, end = period[order], first[order], end[order]
        top = np.maximum.accumulate(end)
        best = np.maximum.accumulate(np.where(end == top, np.arange(len(end)), 0))
        return first, end[best], period[best]


def planted_order(bounds: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Which word stands at each place.  A text whose seed (-1: none) ends in 0 repeats a
    stretch of its own words from some word on; the others keep theirs."""
    order = np.arange(bounds[-1])
    for i in np.flatnonzero((seeds >= 0) & (seeds % 10 == 0) & (np.diff(bounds) > 0)):
        n, g = int(bounds[i + 1] - bounds[i]), int(seeds[i]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        order[bounds[i] + a : bounds[i + 1]] = bounds[i] + a + np.arange(n - a) % p
    return order


def runs_of(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several texts: (text of each run; its first word, word behind, period)."""
    texts = len(bounds) - 1
    starts = bounds[:-1] + np.arange(texts)  # one mark before each following text
    stream = mix64(np.arange(len(hashes) + texts, dtype=np.uint64) + np.uint64(1 << 62))
    stream[np.arange(len(hashes)) + np.repeat(np.arange(texts), np.diff(bounds))] = hashes
    catcher = SquareCatcher(int(np.diff(bounds).max(initial=0)))
    catcher.append(stream)
    found = catcher.runs(least)
    text = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, :2] -= starts[text][:, None]
    return text, found


def _joined(w: Words, words: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The texts whose words are ``words[bounds[i]:bounds[i + 1]]``, joined by a space."""
    out: list[list[bytes]] = [[] for _ in range(len(bounds) - 1)]
    for lo in range(0, len(words), GATHER):
        some = words[lo : lo + GATHER]
        length = w.end[some] - w.start[some] + 1
        stop = np.cumsum(length)
        at = np.arange(stop[-1]) + np.repeat(w.start[some] - (stop - length), length)
        at[stop - 1] = 0
        piece = w.data[at]
        piece[stop - 1] = 0x20
        cut = np.append(0, stop)
        first = np.searchsorted(bounds, lo, side="right") - 1
        for i in range(first, len(bounds) - 1):
            if bounds[i] >= lo + len(some):
                break
            a, b = max(int(bounds[i]) - lo, 0), min(int(bounds[i + 1]) - lo, len(some))
            if b > a:
                out[i].append(piece[cut[a] : cut[b]].tobytes())
    return [b"".join(x)[:-1] for x in out]


def _find(least: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            seeds = batch["seed"].fill_null(-1).to_numpy(zero_copy_only=False)
            for lo, hi in runs(offsets):
                w = Words(data, offsets[lo : hi + 1], fold=False)
                order = planted_order(w.bounds, seeds[lo:hi])
                text, found = runs_of(w.hash[order], w.bounds, least)
                edge = np.zeros(len(order) + 1, np.int64)
                np.add.at(edge, w.bounds[text] + found[:, 0] + found[:, 2], 1)
                np.add.at(edge, w.bounds[text] + found[:, 1], -1)
                kept = np.cumsum(edge[:-1]) == 0
                bounds = np.append(0, np.cumsum(kept))[w.bounds]
                columns = [found[:, 0], found[:, 1] - found[:, 0], found[:, 2]]
                each = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["start", "length", "period"])
                of_text = pa.array(np.searchsorted(text, np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo), pa.ListArray.from_arrays(of_text, each),
                        pa.array(_joined(w, order[kept], bounds), pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )

    return find


def find_runs(docs: DataFrame, least: int = LEAST_LENGTH, seed: Column | None = None) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of at least ``least`` words of each text, by
    first word, then period, and the text without the words that a run repeats.  With
    ``seed``, texts whose seed ends in 0 first get a repetition (``planted_order``)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        (F.lit(None) if seed is None else seed).cast("long").alias("seed"),
    )
    return rows.mapInArrow(_find(least), f"doc_id long, runs {RUNS}, collapsed string")


def op11_dyadic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), seed=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("tie"))))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.tie")).alias("period"),
        F.floor(F.lit(1000) * F.col("longest.length") / -F.col("longest.tie")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit(""))).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
