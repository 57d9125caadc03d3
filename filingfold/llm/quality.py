"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words (Ilse et al. 2018).  Each passage
is encoded: shares of character classes, word lengths, repetition and vocabulary
richness, through a tanh layer.  Gated attention, ``softmax(w . (tanh(V h) * sigm(U h)))``,
weighs the passages; the weighted sum is scored by a logistic layer.  All weights are
learned together from document labels, by Adam on the log loss, in numpy.

Training reads at most ``TRAIN_DOCS`` labelled documents (chosen by a hash of doc_id,
so reruns agree), none of the held-out fold; what reaches the driver is their passage
features, at most ``BAG`` evenly spread passages of each.  Scoring uses every passage
of every text, batch by batch, on the executors.

Defined cases: a null or empty text is one empty passage and gets a score like any
other; passages are scored in the order of the text, so repeated rows score alike; a
document with several labels takes the least; null labels are ignored; without any
labelled row of both classes every score is the share of label 1 (0.5 without labels);
an empty table gives an empty result; only ``text`` is an input of a score, and other
columns pass through ``with_quality``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import crc_fold, table
from filingfold.llm.textkernel import NOT_SPACE, Words, runs, text_buffers

PASSAGE = 64
TRAIN_DOCS = 3000
BAG = 64
HIDDEN = 16
ATTENTION = 8
EPOCHS = 30
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

# Classes of bytes whose shares describe a passage.
CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\r\x0b\x0c",
    b".", b",", b"!", b"?", b";:", b"|", b"#$%&*", b"()[]{}<>", b"'\"`", b"+-=/\\_~^@", bytes(range(0x80, 0x100)),
]
_CLASS = np.full(256, len(CLASSES), np.uint8)
for _i, _c in enumerate(CLASSES):
    _CLASS[list(_c)] = _i
N_FEATURES = len(CLASSES) + 1 + 7


def passage_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, bounds): passages of text i are ``bounds[i]:bounds[i + 1]``; every
    text has at least one."""
    words = Words(data, offsets, NOT_SPACE)
    counts = np.diff(words.bounds)
    per_text = np.maximum(1, -(-counts // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    n = int(bounds[-1])
    first = np.repeat(words.bounds[:-1], per_text) + PASSAGE * (np.arange(n) - np.repeat(bounds[:-1], per_text))
    last = np.minimum(first + PASSAGE, np.repeat(words.bounds[1:], per_text))
    size = last - first
    out = np.zeros((n, N_FEATURES), np.float32)
    if not len(words.start):
        return out, bounds
    raw = data[int(offsets[0]) : int(offsets[-1])]
    full = size > 0
    # Bytes from the passage's first word to its last one.
    begin, stop = np.zeros(n, np.int64), np.zeros(n, np.int64)
    begin[full], stop[full] = words.start[first[full]], words.end[last[full] - 1]
    length = np.maximum(stop - begin, 1)
    owner = np.repeat(np.arange(n), stop - begin)
    place = np.arange(int((stop - begin).sum())) - np.repeat(np.cumsum(stop - begin) - (stop - begin), stop - begin)
    kind = _CLASS[raw[np.repeat(begin, stop - begin) + place]]
    width = len(CLASSES) + 1
    shares = np.bincount(owner * width + kind, minlength=n * width).reshape(n, width)
    out[:, :width] = shares / length[:, None]
    many = np.maximum(size, 1)
    of_word = np.repeat(np.arange(n), size)
    long = (words.end - words.start).astype(np.float64)
    mean = np.bincount(of_word, long, n) / many
    out[:, width] = mean / 10
    out[:, width + 1] = np.sqrt(np.maximum(np.bincount(of_word, long * long, n) / many - mean * mean, 0)) / 10
    same = np.zeros(len(long))
    same[1:] = words.hash[1:] == words.hash[:-1]
    same[first[full]] = 0
    out[:, width + 2] = np.bincount(of_word, same, n) / many
    # Distinct words: sort (passage, hash) and count the steps.
    key = np.sort((of_word.astype(np.uint64) << np.uint64(40)) | (words.hash >> np.uint64(24)))
    step = np.concatenate([[True], key[1:] != key[:-1]])
    out[:, width + 3] = np.bincount((key[step] >> np.uint64(40)).astype(np.int64), minlength=n) / many
    out[:, width + 4] = np.bincount(of_word, long <= 1, n) / many
    out[:, width + 5] = np.bincount(of_word, long >= 12, n) / many
    out[:, width + 6] = np.log1p(size) / np.log1p(PASSAGE)
    return out, bounds


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def forward(m: dict, x: np.ndarray, bounds: np.ndarray) -> dict:
    """Scores of bags of standardised passages, with what the gradient needs."""
    h = np.tanh(x @ m["We"] + m["be"])
    t, s = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = (t * s) @ m["w"]
    at, per = bounds[:-1], np.diff(bounds)
    a = np.exp(e - np.repeat(np.maximum.reduceat(e, at), per))
    a /= np.repeat(np.add.reduceat(a, at), per)
    z = np.add.reduceat(h * a[:, None], at)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ m["c"] + m["b"][0])}


def gradients(m: dict, x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict:
    """Gradient of the mean log loss."""
    f = forward(m, x, bounds)
    at, per = bounds[:-1], np.diff(bounds)
    d = (f["p"] - y) / len(y)
    dz = d[:, None] * m["c"]
    rows = np.repeat(dz, per, axis=0)
    da = (rows * f["h"]).sum(1)
    de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, at), per))
    gate = de[:, None] * m["w"]
    dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
    dh = rows * f["a"][:, None] + dt @ m["V"].T + ds @ m["U"].T
    du = dh * (1 - f["h"] ** 2)
    return {
        "We": x.T @ du, "be": du.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
        "w": ((f["t"] * f["s"]) * de[:, None]).sum(0), "c": (f["z"] * d[:, None]).sum(0), "b": np.array([d.sum()]),
    }


def fit(bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> dict:
    """Learned weights, with the mean and spread that standardise features."""
    prior = float(y.mean()) if len(y) else 0.5
    if not len(y) or prior in (0.0, 1.0):
        return {"prior": prior}
    flat = np.concatenate(bags)
    mean, spread = flat.mean(0), flat.std(0) + 1e-3
    rng = np.random.default_rng(seed)
    m = {
        "We": rng.normal(0, 0.3, (N_FEATURES, HIDDEN)), "be": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, ATTENTION)),
        "U": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "w": rng.normal(0, 0.3, ATTENTION), "c": rng.normal(0, 0.3, HIDDEN),
        "b": np.array([np.log(prior / (1 - prior))]),
    }
    first, second, step = {k: 0 * v for k, v in m.items()}, {k: 0 * v for k, v in m.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 64):
            some = order[lo : lo + 64]
            x = np.clip((np.concatenate([bags[i] for i in some]) - mean) / spread, -8, 8)
            bounds = np.concatenate([[0], np.cumsum([len(bags[i]) for i in some])])
            step += 1
            for k, g in gradients(m, x, bounds, y[some]).items():
                g = g + 1e-4 * m[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = 0.01 * (0.5 if epoch > epochs // 2 else 1)
                m[k] = m[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in m.items()} | {"mean": mean, "spread": spread}


def score_texts(model: dict, column: pa.Array) -> np.ndarray:
    if "prior" in model:
        return np.full(len(column), model["prior"])
    data, offsets = text_buffers(column)
    out = np.zeros(len(column))
    for lo, hi in runs(offsets):
        x, bounds = passage_features(data, offsets[lo : hi + 1])
        out[lo:hi] = forward(model, np.clip((x - model["mean"]) / model["spread"], -8, 8), bounds)["p"]
    return out


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch["text"])
        for lo, hi in runs(offsets):
            x, bounds = passage_features(data, offsets[lo : hi + 1])
            rows = []
            for i in range(hi - lo):
                own = x[bounds[i] : bounds[i + 1]]
                if len(own) > BAG:
                    own = own[np.linspace(0, len(own) - 1, BAG).astype(int)]
                rows.append(own.reshape(-1).tolist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), batch["quality"].slice(lo, hi - lo), pa.array(rows, pa.list_(pa.float32()))], names=["doc_id", "quality", "bag"])


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> dict:
    """Fit on at most ``limit`` labelled documents outside the held-out fold."""
    marked = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).withColumn("_fold", crc_fold(FOLDS))
        .filter(F.col("_fold") != HELD_OUT).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Of rows that repeat a doc_id one text goes on: at most ``limit`` in all.
    once = texts.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = once.mapInArrow(_bags, "doc_id long, quality int, bag array<float>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    bags = [np.asarray(b, np.float32).reshape(-1, N_FEATURES) for b in rows["bag"]]
    return fit(bags, rows["quality"].to_numpy(float))


def with_quality(docs: DataFrame, model: dict, into: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``into``."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(score_texts(model, text))

    return docs.withColumn(into, score(F.col("text").cast("string")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those scored below ``threshold``."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "text")
    return with_quality(packed, train(docs, labels)).filter(F.col("score") >= threshold).select("row.*")


def op8_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_quality(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (crc_fold(FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
