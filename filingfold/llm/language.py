"""Language of texts by a linear-chain conditional random field over words.

Each word is labelled with a language.  Emissions come from byte bigrams and trigrams,
from prefix and suffix (up to three bytes, hashed) and from a lexicon (words typical
of one language in the training sample); learned transitions between neighbouring
words carry the context through code-switched text.  Training minimises the negative
log-likelihood by Adagrad on sequences spliced from segments of two documents, half
of them in two languages, so the transitions see switches.  Forward-backward gives
each word's posterior; a text takes the language with the largest mean posterior,
which is its score.

Training reads at most ``TRAIN_DOCS`` documents of each language and ``SEGMENTS``
segments of each, evenly spread over the text; held-out documents are never read.
More than ``MAX_LANGS`` languages raise an error.  Labelling reads every word of every
text, batch by batch, on the executors.

Words are runs of letters (ASCII letters and everything outside ASCII), lower-cased
within ASCII and Latin-1.

Defined cases: a null text and a text without letters are ``und`` with score 0, and
so is every text when no training row has a language; equal texts get equal results;
on equal scores the language first in code point order wins; an empty table gives an
empty result; only the text is an input, and other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filingfold.llm.common import crc_fold, table
from filingfold.llm.textkernel import Words, runs, text_buffers

TRAIN_DOCS = 250
SEGMENTS = 6
LENGTH = 32
EPOCHS = 3
MAX_LANGS = 64
FOLDS, HELD_OUT = 4, 2
LEXICON_MIN = 3
LEXICON_SHARE = 0.8
RUN = 4 << 20

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
LETTER = ASCII_LETTER.copy()
LETTER[0x80:] = True
_BI, _TRI, _AFFIX = 1 << 16, 1 << 16, 1 << 15
_TRI_AT, _PRE_AT, _SUF_AT = _BI, _BI + _TRI, _BI + _TRI + _AFFIX
_ROWS = _SUF_AT + _AFFIX


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower-cases the two-byte capitals of Latin-1 (A-Z are lower-cased by Words)."""
    out = data.copy()
    second = out[1:]
    second[(out[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)] += 0x20
    return out


class Features:
    """Feature rows of each distinct word (bytes ``start:end`` of ``data``)."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        n = end - start
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(begin, n)
        left = np.repeat(n, n) - place
        b = data[np.repeat(start, n) + place].astype(np.int64)
        self.two = np.flatnonzero(left >= 2)
        self.bi = b[self.two] * 256 + b[self.two + 1]
        three = np.flatnonzero(left >= 3)
        self.tri = _TRI_AT + (((b[three] * 0x9E37 + b[three + 1]) * 0x85EB + b[three + 2] * 0xC2B3) >> 3) % _TRI
        self.n_bi, self.n_tri = np.maximum(n - 1, 0), np.maximum(n - 2, 0)
        at = lambda i, ok: np.where(ok, b[np.clip(i, 0, len(b) - 1)], 0)
        last = begin + n - 1
        self.pre = _PRE_AT + self._affix(at(begin, n > 0), at(begin + 1, n > 1), at(begin + 2, n > 2))
        self.suf = _SUF_AT + self._affix(at(last, n > 0), at(last - 1, n > 1), at(last - 2, n > 2))

    @staticmethod
    def _affix(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
        return (((x * 0x9E37 + y) * 0x85EB + z * 0xC2B3) >> 2) % _AFFIX

    def emissions(self, weights: np.ndarray, lexicon: np.ndarray, lexicon_weights: np.ndarray) -> np.ndarray:
        out = weights[self.pre] + weights[self.suf] + lexicon @ lexicon_weights
        for index, count in ((self.bi, self.n_bi), (self.tri, self.n_tri)):
            some = np.flatnonzero(count)
            if len(some):
                first = np.cumsum(count[some]) - count[some]
                out[some] += np.add.reduceat(weights[index], first, axis=0) / np.sqrt(count[some])[:, None]
        return out

    def scatter(self, grad: np.ndarray, rows: int) -> np.ndarray:
        """Gradient of the weight rows from that of the words."""
        per_bi = np.repeat(grad / np.sqrt(np.maximum(self.n_bi, 1))[:, None], self.n_bi, axis=0)
        per_tri = np.repeat(grad / np.sqrt(np.maximum(self.n_tri, 1))[:, None], self.n_tri, axis=0)
        index = np.concatenate([self.bi, self.tri, self.pre, self.suf])
        value = np.concatenate([per_bi, per_tri, grad, grad])
        return np.stack([np.bincount(index, value[:, k], rows) for k in range(grad.shape[1])], axis=1)


def _lexicon_rows(model: dict, hashes: np.ndarray) -> np.ndarray:
    known, owner = model["lexicon"], model["owner"]
    out = np.zeros((len(hashes), len(model["langs"])), np.float32)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = np.flatnonzero(known[at] == hashes)
        out[hit, owner[at[hit]]] = 1
    return out


def word_emissions(model: dict, words: Words) -> np.ndarray:
    """(words, languages) scores; each distinct word of the run is scored once."""
    distinct, first, where = np.unique(words.hash, return_index=True, return_inverse=True)
    features = Features(words.data, words.start[first], words.end[first])
    return features.emissions(model["weights"], _lexicon_rows(model, distinct), model["lexicon_weights"])[where]


def posteriors(emission: np.ndarray, bounds: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Forward-backward over many sequences at once, ``bounds`` as in Words: step t
    treats the t-th word of every sequence that is long enough."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    lengths, first = lengths[order], bounds[:-1][order]
    steps = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(steps), side="left")  # sequences longer than t
    at = np.concatenate([[0], np.cumsum(live)])
    # Time-major order: word t of sequence rank r lies at at[t] + r.
    rank = np.arange(int(at[-1])) - np.repeat(at[:-1], live)
    source = first[rank] + np.repeat(np.arange(steps), live)
    e = emission[source]
    e = np.exp(e - e.max(1, keepdims=True)).astype(np.float32)
    move, begin = np.exp(transitions).astype(np.float32), np.exp(start).astype(np.float32)
    alpha = np.empty_like(e)
    for t in range(steps):
        lo, hi = at[t], at[t + 1]
        a = e[lo:hi] * (begin if t == 0 else alpha[at[t - 1] : at[t - 1] + hi - lo] @ move)
        alpha[lo:hi] = a / a.sum(1, keepdims=True)
    gamma = np.empty_like(e)
    beta = np.zeros((0, e.shape[1]), np.float32)
    for t in range(steps - 1, -1, -1):
        lo, hi = at[t], at[t + 1]
        now = np.ones((hi - lo, e.shape[1]), np.float32)
        if len(beta):
            now[: len(beta)] = (e[at[t + 1] : at[t + 1] + len(beta)] * beta) @ move.T
            now /= now.sum(1, keepdims=True)
        g = alpha[lo:hi] * now
        gamma[lo:hi] = g / g.sum(1, keepdims=True)
        beta = now
    out = np.empty_like(gamma)
    out[source] = gamma
    return out


def chain_gradient(emission: np.ndarray, gold: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Gradients (emission, transitions, start) of the mean negative log-likelihood of
    equally long sequences: emission (n, length, languages), gold (n, length)."""
    n, length, k = emission.shape
    e = np.exp(emission - emission.max(2, keepdims=True))
    move, begin = np.exp(transitions), np.exp(start)
    alpha, beta = np.empty_like(e), np.ones_like(e)
    for t in range(length):
        a = e[:, t] * (begin if t == 0 else alpha[:, t - 1] @ move)
        alpha[:, t] = a / a.sum(1, keepdims=True)
    for t in range(length - 2, -1, -1):
        b = (e[:, t + 1] * beta[:, t + 1]) @ move.T
        beta[:, t] = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    pair = alpha[:, :-1, :, None] * move * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    hot = np.eye(k)[gold]
    d_move = pair.sum((0, 1)) - np.einsum("ntk,ntl->kl", hot[:, :-1], hot[:, 1:])
    return (gamma - hot) / n, d_move / n, (gamma[:, 0] - hot[:, 0]).sum(0) / n


def fit(segments: list[tuple[str, str]], seed: int = 5, epochs: int = EPOCHS) -> dict:
    """Train from (language, segment of LENGTH words) pairs."""
    langs = sorted({lang for lang, _ in segments})
    if not langs:
        return {"langs": []}
    k = len(langs)
    texts = [fold_case(np.frombuffer(s.encode(), np.uint8)) for _, s in segments]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words = Words(np.concatenate(texts), offsets, LETTER)
    lang = np.array([langs.index(x) for x, _ in segments])
    usable = np.flatnonzero(np.diff(words.bounds) >= 1)
    of_word = np.repeat(np.arange(len(segments)), np.diff(words.bounds))
    distinct, first, where = np.unique(words.hash, return_index=True, return_inverse=True)
    # Lexicon: words seen often enough, and mostly in one language.
    seen = np.bincount(where * k + lang[of_word], minlength=len(distinct) * k).reshape(-1, k)
    typical = (seen.sum(1) >= LEXICON_MIN) & (seen.max(1) >= LEXICON_SHARE * seen.sum(1))
    model = {
        "langs": langs, "lexicon": distinct[typical], "owner": seen[typical].argmax(1), "weights": np.zeros((_ROWS, k), np.float32),
        "lexicon_weights": np.zeros((k, k), np.float32), "transitions": np.zeros((k, k)), "start": np.zeros(k),
    }
    squares = {name: np.full(model[name].shape, 1e-8) for name in ("weights", "lexicon_weights", "transitions", "start")}
    rng = np.random.default_rng(seed)
    place = np.arange(LENGTH)
    for _ in range(epochs):
        one, two = rng.permutation(usable), rng.permutation(usable)
        # Half of the sequences stay in one language.
        stay = rng.random(len(usable)) < 0.5
        two = np.where(stay, one, two)
        cut = rng.integers(4, LENGTH - 3, len(usable))
        for lo in range(0, len(usable), 96):
            a, b, c = one[lo : lo + 96], two[lo : lo + 96], cut[lo : lo + 96]
            owner = np.where(place < c[:, None], a[:, None], b[:, None])
            size = np.diff(words.bounds)[owner]
            which = words.bounds[owner] + place % size
            used, back = np.unique(where[which], return_inverse=True)
            features = Features(words.data, words.start[first[used]], words.end[first[used]])
            lexicon = _lexicon_rows(model, distinct[used])
            emission = features.emissions(model["weights"], lexicon, model["lexicon_weights"])
            back = back.reshape(which.shape)
            d_emission, d_move, d_start = chain_gradient(emission[back].astype(float), lang[owner], model["transitions"], model["start"])
            d_word = np.stack([np.bincount(back.ravel(), d_emission[..., j].ravel(), len(used)) for j in range(k)], axis=1)
            for name, g in (
                ("weights", features.scatter(d_word, _ROWS)), ("lexicon_weights", lexicon.T @ d_word),
                ("transitions", d_move), ("start", d_start),
            ):
                squares[name] += g * g
                model[name] = (model[name] - 0.3 * g / np.sqrt(squares[name])).astype(model[name].dtype)
    return model


def label_texts(model: dict, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    langs, scores = ["und"] * len(column), np.zeros(len(column))
    if not model["langs"]:
        return langs, scores
    data, offsets = text_buffers(column)
    for lo, hi in runs(offsets, RUN):
        own = data[int(offsets[lo]) : int(offsets[hi])]
        at = offsets[lo : hi + 1] - offsets[lo]
        words = Words(fold_case(own), at, LETTER)
        if not len(words.start):
            continue
        n = np.diff(words.bounds)
        gamma = posteriors(word_emissions(model, words), words.bounds, model["transitions"], model["start"])
        some = np.flatnonzero(n)
        mean = np.add.reduceat(gamma, words.bounds[some], axis=0) / n[some][:, None]
        plain = np.concatenate([[0], np.cumsum(ASCII_LETTER[own])])
        plain = plain[at[1:]] > plain[at[:-1]]
        for i, row in zip(some, mean, strict=True):
            if plain[i] or any(ch.isalpha() for ch in own[at[i] : at[i + 1]].tobytes().decode()):
                best = int(row.argmax())
                langs[lo + i], scores[lo + i] = model["langs"][best], min(1.0, float(row[best]))
    return langs, scores


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, out = [], []
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            words = (text or "").split()
            last = max(0, len(words) - LENGTH)
            for at in sorted({round(last * i / (SEGMENTS - 1)) for i in range(SEGMENTS)}):
                langs.append(lang)
                out.append(" ".join(w[:64] for w in words[at : at + LENGTH]))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.string())], names=["lang", "segment"])


def train(docs: DataFrame, limit: int = TRAIN_DOCS) -> dict:
    """Fit on at most ``limit`` different texts of each language outside the held-out fold."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (crc_fold(FOLDS) != HELD_OUT))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("h"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(MAX_LANGS + 1)
    sizes = {r["lang"]: max(1, r["n"]) for r in counts.collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not sizes:
        return fit([])
    spark = docs.sparkSession
    share = spark.createDataFrame([(x, min(1.0, 3.0 * limit / n)) for x, n in sizes.items()], "lang string, share double")
    # About three times the limit of each language's different texts is ranked, whatever
    # the input's size; hashes are even, so the least ones are a draw.
    dice = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    some = rows.select("h", "lang").join(F.broadcast(share), "lang").filter(dice < F.col("share")).select("h", "lang").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 11), "h"))
    chosen = some.withColumn("rank", rank).filter(F.col("rank") <= limit).select("h", "lang")
    # Rows that repeat a doc_id and text are one: at most ``limit`` texts of a language go on.
    once = rows.join(F.broadcast(chosen), ["h", "lang"]).groupBy("h", "lang").agg(F.min("text").alias("text"))
    texts = once.mapInArrow(_segments, "lang string, segment string")
    got = texts.orderBy("lang", "segment").collect()  # at most limit * SEGMENTS rows of each language
    return fit([(r["lang"], r["segment"]) for r in got])


def with_language(docs: DataFrame, model: dict, into: str = "language") -> DataFrame:
    """``docs`` with the struct (lang, score) in column ``into``."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def label(text: pa.Array) -> pa.Array:
        langs, scores = label_texts(model, text)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], names=["lang", "score"])

    return docs.withColumn(into, label(F.col("text").cast("string")))


def op3_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = with_language(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id", (crc_fold(FOLDS) == HELD_OUT).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
    )
