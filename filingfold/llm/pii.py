"""Personal data: fixed base rules plus a character BiLSTM with CRF transitions.

Base spans follow the four rules of ``base_spans`` exactly.  The model adds spans the
rules miss (a phone number without country code, an address with a spelled-out at):
a bidirectional LSTM over character classes (``HIDDEN`` cells a direction), a linear
layer and a CRF over the labels none, email, ip, card, phone, all trained in numpy on
labelled spans: real base spans with the text around them, and generated ones set into
real clean text, with look-alikes (dates, versions, prices) as negatives.

Texts of any length are cut into overlapping windows: ``CORE`` characters are decided
by each window, ``PAD`` on both sides give context.  Windows are decoded by Viterbi;
those where "none" throughout provably wins are not decoded (the same result).  Every
kind needs a digit, an @ or an at spelled out before a dotted name (``SIGN``), so only
windows that see one of these run through the model; the others are "none".  The decided
parts are joined to one label sequence per text, so a span over a window's
edge is one span.  A model span counts if its mean posterior is at least ``SURE``, it
has ``SHORTEST`` characters, it passes ``plausible``, and no base span overlaps it.

Training reads at most ``TRAIN_DOCS`` different texts (by a hash of doc_id and text) and
``WINDOWS`` windows of each; labelling reads every character of every text on the executors.

Defined cases: a null or empty text has no spans; offsets are code points, ends
exclusive; repeated rows have the same spans; without any training text the model is
trained on generated spans alone; an empty table gives an empty result; only the text
is an input, and other columns pass through ``with_spans``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import table

KINDS = ["email", "ip", "card", "phone"]
HIDDEN = 8
CORE, PAD = 224, 32
SURE, SHORTEST = 0.9, 7
TRAIN_DOCS, WINDOWS = 600, 4
TRAIN_LENGTH, TRAIN_STEPS, TRAIN_BATCH = 48, 500, 64
BATCH_CHARS = 1 << 20

# The base rules, written without backtracking (same matches).
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What no span is without.
SIGN = re.compile(r"[0-9@]++|\W(?:at|AT)\W\s*+[A-Za-z0-9-]++\.")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    pos, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        pos = m.end() if m else at + 1
        at = text.find("@", pos)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules, sorted by start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = re.sub(r"[\x20-]", "", m.group()) if m.end() - m.start() <= 40 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# --- characters -------------------------------------------------------------
PUNCTUATION = ".@-_+():/,;%#$'\"[]{}|!?&*=<>"
N_CLASSES = 26 + 26 + 1 + 2 + len(PUNCTUATION) + 2
_NEWLINE, _OTHER = 54, 55 + len(PUNCTUATION)
CLASS = np.full(1 << 16, _OTHER + 1, np.uint8)  # outside ASCII
CLASS[:128] = _OTHER
CLASS[ord("a") : ord("z") + 1] = np.arange(26)
CLASS[ord("A") : ord("Z") + 1] = np.arange(26, 52)
CLASS[ord("0") : ord("9") + 1] = 52
CLASS[ord(" ")] = 53
CLASS[[9, 10, 13]] = _NEWLINE
for _i, _ch in enumerate(PUNCTUATION):
    CLASS[ord(_ch)] = 55 + _i


def plausible(kind: int, span: str) -> bool:
    """Whether a model span can be of its kind: a card passes Luhn, an address has four
    parts up to 255, a phone 7 to 15 digits, an e-mail an at (also spelled out) and a dot."""
    digits = "".join(ch for ch in span if "0" <= ch <= "9")
    if kind == 0:
        return "." in span and re.search(r"@|\W(?:at|AT)\W", span) is not None
    if kind == 1:
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CLASS[np.minimum(points, 0xFFFF)]


# --- BiLSTM-CRF -------------------------------------------------------------
def lstm(x: np.ndarray, embed: np.ndarray, recur: np.ndarray, keep: bool = False):
    """Hidden states (length, n, HIDDEN) of class matrix x (length, n).  Gates are in,
    forget, out, cell; the first three are a logistic written with tanh."""
    n = x.shape[1]
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out = np.empty((*x.shape, HIDDEN), np.float32)
    memory = []
    g = np.empty((n, 4 * HIDDEN), np.float32)
    for t in range(len(x)):
        np.matmul(h, recur, out=g)
        g += embed[x[t]]
        np.tanh(g, out=g)
        s = 0.5 + 0.5 * g[:, : 3 * HIDDEN]
        old = c
        c = s[:, HIDDEN : 2 * HIDDEN] * c + s[:, :HIDDEN] * g[:, 3 * HIDDEN :]
        tc = np.tanh(c)
        if keep:
            memory.append((s, g[:, 3 * HIDDEN :].copy(), old, tc, h))
        h = s[:, 2 * HIDDEN :] * tc
        out[t] = h
    return (out, memory) if keep else out


def lstm_gradient(x: np.ndarray, recur: np.ndarray, memory: list, d_out: np.ndarray, n_classes: int):
    """Gradients of the embedding and recurrent tables (both directions of time share
    this code; the backward direction passes reversed arrays)."""
    d_embed = np.zeros((n_classes, 4 * HIDDEN))
    d_recur = np.zeros_like(recur, dtype=float)
    dh_next = np.zeros((x.shape[1], HIDDEN))
    dc = np.zeros((x.shape[1], HIDDEN))
    for t in range(len(x) - 1, -1, -1):
        s, cell, old, tc, h = memory[t]
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
        dh = d_out[t] + dh_next
        dc = dc + dh * o * (1 - tc * tc)
        # d tanh(z) with s = (1 + tanh z) / 2: ds/dz = 2 s (1 - s).
        dz = np.concatenate([
            dc * cell * 2 * i * (1 - i), dc * old * 2 * f * (1 - f), dh * tc * 2 * o * (1 - o), dc * i * (1 - cell * cell),
        ], axis=1)
        np.add.at(d_embed, x[t], dz)
        d_recur += h.T @ dz
        dh_next = dz @ recur.T
        dc = dc * f
    return d_embed, d_recur


def _scan(x: np.ndarray, embed: np.ndarray, recur: np.ndarray, out: np.ndarray, e: np.ndarray) -> None:
    """Adds one direction's emissions to e (length, labels, n).  The same cell as in
    ``lstm``, cells by rows, so that every step runs over contiguous memory; hidden
    states are kept doubled, which spares the halving of the output gate."""
    n = x.shape[1]
    table = np.ascontiguousarray(embed.T)
    step, emit = np.ascontiguousarray(recur.T * np.float32(0.5)), np.ascontiguousarray(out.T * np.float32(0.5))
    h, c, tc = (np.zeros((HIDDEN, n), np.float32) for _ in range(3))
    g, pre, part = np.empty((4 * HIDDEN, n), np.float32), np.empty((4 * HIDDEN, n), np.float32), np.empty(e.shape[1:], np.float32)
    gates, cell = g[: 3 * HIDDEN], g[3 * HIDDEN :]
    for t in range(len(x)):
        np.take(table, x[t], axis=1, out=pre, mode="clip")
        np.matmul(step, h, out=g)
        g += pre
        np.tanh(g, out=g)
        gates += 1
        c *= gates[HIDDEN : 2 * HIDDEN]
        cell *= gates[:HIDDEN]
        c += cell
        c *= np.float32(0.5)
        np.tanh(c, out=tc)
        np.multiply(gates[2 * HIDDEN :], tc, out=h)
        e[t] += np.matmul(emit, h, out=part)


def emissions(m: dict, x: np.ndarray) -> np.ndarray:
    """(length, n, labels) of class matrix x (length, n)."""
    e = np.empty((len(x), len(m["bias"]), x.shape[1]), np.float32)
    e[:] = m["bias"][:, None]
    at = x.astype(np.intp)
    _scan(at, m["embed_f"], m["recur_f"], m["out_f"], e)
    _scan(at[::-1], m["embed_b"], m["recur_b"], m["out_b"], e[::-1])
    return e.transpose(0, 2, 1)


def crf_posterior(e: np.ndarray, move: np.ndarray, start: np.ndarray):
    """Forward-backward: (posterior of each label, of each pair of neighbours in turn)."""
    x = np.exp(e - e.max(2, keepdims=True))
    big = np.exp(move)
    alpha, beta = np.empty_like(x), np.ones_like(x)
    for t in range(len(e)):
        a = x[t] * (np.exp(start) if t == 0 else alpha[t - 1] @ big)
        alpha[t] = a / a.sum(1, keepdims=True)
    for t in range(len(e) - 2, -1, -1):
        b = (x[t + 1] * beta[t + 1]) @ big.T
        beta[t] = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    return gamma / gamma.sum(2, keepdims=True), (alpha[:-1], big, x[1:] * beta[1:])


def crf_gradient(e: np.ndarray, gold: np.ndarray, move: np.ndarray, start: np.ndarray):
    """Gradients (emission, move, start) of the mean negative log-likelihood; e is
    (length, n, labels), gold (length, n)."""
    gamma, (left, big, right) = crf_posterior(e, move, start)
    n, k = e.shape[1:]
    pair = left[:, :, :, None] * big * right[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    hot = np.eye(k)[gold]
    d_move = pair.sum((0, 1)) - np.einsum("tnk,tnl->kl", hot[:-1], hot[1:])
    return (gamma - hot) / n, d_move / n, (gamma[0] - hot[0]).sum(0) / n


def viterbi(e: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best label sequences (length, n)."""
    length, n, k = e.shape
    best = e[0] + start
    back = np.empty((length, n, k), np.int8)
    for t in range(1, length):
        options = best[:, :, None] + move
        back[t] = options.argmax(1)
        best = options.max(1) + e[t]
    out = np.empty((length, n), np.int8)
    out[-1] = best.argmax(1)
    rows = np.arange(n)
    for t in range(length - 1, 0, -1):
        out[t - 1] = back[t][rows, out[t]]
    return out


def may_hold_spans(e: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """False where "none" throughout is certainly the best sequence.  A stretch of r
    other labels gains at most ``enter + (r - 1) * stay + leave`` by transitions and
    loses the lead of "none" at each place; the best stretch of each window is found by
    a running maximum and compared with nothing gained."""
    none = move[0, 0]
    enter, begin = float((move[0, 1:] - none).max()), float((start[1:] - start[0]).max())
    leave, stay = float((move[1:, 0] - none).max()), float((move[1:, 1:] - none).max())
    gain = stay - (e[:, :, 0] - e[:, :, 1:].max(2))
    run = np.full(e.shape[1], -np.inf, np.float32)
    best = run.copy()
    for g in gain:
        run = np.maximum(run, 0) + g
        best = np.maximum(best, run)
    first = np.cumsum(gain, axis=0)  # stretches from the window's first place
    # A stretch up to the window's end leaves by no transition.
    inner = np.maximum(best + leave, run) + enter
    outer = np.maximum(first.max(0) + leave, first[-1]) + begin
    return np.maximum(inner, outer) - stay >= 0


def decode(m: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(labels, posterior of the label) of class matrix x (length, n)."""
    e = emissions(m, x)
    labels = np.zeros(x.shape, np.int8)
    sure = np.ones(x.shape, np.float32)
    some = np.flatnonzero(may_hold_spans(e, m["move"], m["start"]))
    if len(some):
        e = e[:, some]
        found = viterbi(e, m["move"], m["start"])
        labels[:, some] = found
        gamma, _ = crf_posterior(e, m["move"], m["start"])
        sure[:, some] = np.take_along_axis(gamma, found[:, :, None].astype(np.int64), 2)[:, :, 0]
    return labels, sure


# --- training ---------------------------------------------------------------
def made_span(rng: np.random.Generator) -> tuple[int, str]:
    """A labelled span (kind 1..4), also in forms the base rules miss, or a look-alike
    (kind 0)."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    letters = lambda n: "".join(chr(97 + int(i)) for i in rng.integers(0, 26, n))
    pick = lambda *options: options[int(rng.integers(len(options)))]
    hexes = lambda n: "".join("0123456789abcdef"[int(i)] for i in rng.integers(0, 16, n))
    word = lambda: letters(int(rng.integers(3, 10)))
    kind = int(rng.integers(0, 6))
    if kind == 1:
        local = pick(word(), f"{word()}.{word()}", f"{word()}.{digits(2)}", f"{word()}_{digits(3)}", f"{word()}+{word()}")
        host = pick(f"{word()}.{pick('com', 'org', 'net', 'de', 'fr')}", f"mail{digits(1)}.{word()}.com", f"{word()}.co.uk")
        return 1, local + pick("@", "@", "@", "(at)", "[at]", " at ") + host
    if kind == 2:
        return 2, ".".join(str(int(i)) for i in rng.integers(0, 256, 4))
    if kind == 3:
        d = digits(16)
        return 3, pick(d, " ".join(d[i : i + 4] for i in range(0, 16, 4)), "-".join(d[i : i + 4] for i in range(0, 16, 4)))
    if kind == 4:
        a, b, c = digits(3), digits(3), digits(4)
        return 4, pick(f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{digits(2)} {a} {b} {c}", f"+1-{a}-{b}-{c}", f"{a}.{b}.{c}")
    return 0, pick(
        f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(1)}.{digits(2)}", f"v{digits(1)}.{digits(1)}.{digits(2)}", f"{digits(2)}:{digits(2)}",
        f"${digits(3)}", digits(4), digits(2) + "%", f"{digits(2)},{digits(3)}", f"http://{word()}.com/{word()}", f"@{word()}", f"#{digits(3)}",
        f"{word()}.{word()}", f"{digits(1)}.{digits(1)}", f"[{digits(1)}]", "***", f"{word()}&&&", f"{word()} | {word()}",
        f'{word()} = "{hexes(32)}"', f"{word()}={hexes(24)}", f"{word()}_{hexes(16)}", " ".join([word()] * 4),
    )


def training_set(texts: list[tuple[str, list[tuple[int, int, int]]]], rng: np.random.Generator, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(classes, labels), both (TRAIN_LENGTH, rows): windows of real text with their
    base spans, half of the clean ones with a made span set in."""
    x = np.full((rows, TRAIN_LENGTH), _NEWLINE, np.uint8)
    y = np.zeros((rows, TRAIN_LENGTH), np.int64)
    marked = [t for t in texts if t[1]]
    plain = [t for t in texts if not t[1]] or [("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod", [])]
    for r in range(rows):
        if marked and rng.random() < 0.25:
            text, spans = marked[int(rng.integers(len(marked)))]
            label = np.zeros(len(text), np.int64)
            for a, kind, b in spans:
                label[a:b] = kind + 1
        else:
            text, _ = plain[int(rng.integers(len(plain)))]
            label = np.zeros(len(text), np.int64)
            for _ in range(int(rng.integers(0, 3))):
                kind, span = made_span(rng)
                at = int(rng.integers(0, len(text) + 1))
                before, after = text[:at], text[at:]
                left = " " if rng.random() < 0.9 else "\n"
                text = f"{before}{left}{span} {after}"
                label = np.concatenate([label[:at], [0], np.full(len(span), kind), [0], label[at:]])
        room = max(0, len(text) - TRAIN_LENGTH)
        at = int(rng.integers(0, room + 1))
        n = min(TRAIN_LENGTH, len(text) - at)
        shift = int(rng.integers(0, TRAIN_LENGTH - n + 1))
        x[r, shift : shift + n] = classes(text)[at : at + n]
        y[r, shift : shift + n] = label[at : at + n]
    return x.T.copy(), y.T.copy()


def fit(texts: list[tuple[str, list[tuple[int, int, int]]]], steps: int = TRAIN_STEPS, seed: int = 11) -> dict:
    """Train by Adam on the CRF's negative log-likelihood."""
    rng = np.random.default_rng(seed)
    k = len(KINDS) + 1
    m = {
        "embed_f": rng.normal(0, 0.4, (N_CLASSES, 4 * HIDDEN)), "embed_b": rng.normal(0, 0.4, (N_CLASSES, 4 * HIDDEN)),
        "recur_f": rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN)), "recur_b": rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN)),
        "out_f": rng.normal(0, 0.3, (HIDDEN, k)), "out_b": rng.normal(0, 0.3, (HIDDEN, k)), "bias": np.zeros(k),
        "move": np.zeros((k, k)), "start": np.zeros(k),
    }
    m["embed_f"][:, HIDDEN : 2 * HIDDEN] += 0.5  # remember at first
    m["embed_b"][:, HIDDEN : 2 * HIDDEN] += 0.5
    m = {name: v.astype(np.float32) for name, v in m.items()}
    first, second = {n: np.zeros(v.shape) for n, v in m.items()}, {n: np.zeros(v.shape) for n, v in m.items()}
    x_all, y_all = training_set(texts, rng, TRAIN_BATCH * 100)
    for step in range(1, steps + 1):
        some = rng.integers(0, x_all.shape[1], TRAIN_BATCH)
        x, y = x_all[:, some], y_all[:, some]
        hf, keep_f = lstm(x, m["embed_f"], m["recur_f"], keep=True)
        hb, keep_b = lstm(x[::-1], m["embed_b"], m["recur_b"], keep=True)
        e = hf @ m["out_f"] + hb[::-1] @ m["out_b"] + m["bias"]
        d, d_move, d_start = crf_gradient(e, y, m["move"], m["start"])
        g = {
            "move": d_move, "start": d_start, "bias": d.sum((0, 1)),
            "out_f": np.einsum("tnh,tnk->hk", hf, d), "out_b": np.einsum("tnh,tnk->hk", hb[::-1], d),
        }
        g["embed_f"], g["recur_f"] = lstm_gradient(x, m["recur_f"], keep_f, d @ m["out_f"].T, N_CLASSES)
        g["embed_b"], g["recur_b"] = lstm_gradient(x[::-1], m["recur_b"], keep_b, (d @ m["out_b"].T)[::-1], N_CLASSES)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = 0.06 if step < steps * 0.5 else 0.02 if step < steps * 0.8 else 0.006
        for name in m:
            v = g[name] * min(1.0, 5.0 / (norm + 1e-9))
            first[name] = 0.9 * first[name] + 0.1 * v
            second[name] = 0.99 * second[name] + 0.01 * v * v
            m[name] = (m[name] - rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return m


# --- whole texts ------------------------------------------------------------
def model_spans(m: dict, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the model for each text, from windows of all of them."""
    codes = [classes(t) for t in texts]
    owner, begin = [], []
    for i, (text, c) in enumerate(zip(texts, codes, strict=True)):
        starts = np.arange(0, len(c), CORE)
        seen = np.zeros(len(starts) + 1, np.int64)  # windows that see a sign
        for m_ in SIGN.finditer(text):
            seen[max(0, m_.start() - PAD) // CORE] += 1
            seen[min(len(starts), (m_.end() - 1 + PAD) // CORE + 1)] -= 1
        starts = starts[np.cumsum(seen[:-1]) > 0]
        begin.append(starts)
        owner.append(np.full(len(starts), i))
    owner, begin = np.concatenate(owner), np.concatenate(begin)
    length = CORE + 2 * PAD
    labels = [np.zeros(len(c), np.int8) for c in codes]
    sures = [None] * len(codes)
    step = max(1, BATCH_CHARS // 4 // length)
    for lo in range(0, len(owner), step):
        own, at = owner[lo : lo + step], begin[lo : lo + step]
        x = np.full((len(own), length), _NEWLINE, np.uint8)
        for r, (i, b) in enumerate(zip(own, at, strict=True)):
            a, z = max(0, b - PAD), min(len(codes[i]), b + CORE + PAD)
            x[r, a - b + PAD : z - b + PAD] = codes[i][a:z]
        found, sure = decode(m, np.ascontiguousarray(x.T))
        found, sure = found[PAD : PAD + CORE].T, sure[PAD : PAD + CORE].T
        for r in np.flatnonzero(found.any(1)):
            i, b = own[r], at[r]
            n = min(CORE, len(codes[i]) - b)
            if sures[i] is None:
                sures[i] = np.ones(len(codes[i]), np.float32)
            labels[i][b : b + n] = found[r, :n]
            sures[i][b : b + n] = sure[r, :n]
    out = []
    for text, label, sure in zip(texts, labels, sures, strict=True):
        spans = []
        if sure is not None:
            edge = np.flatnonzero(np.diff(label, prepend=0, append=0))
            for a, z in zip(edge[:-1], edge[1:], strict=True):
                if label[a]:
                    kind = int(label[a]) - 1
                    while a < z and not (text[a].isalnum() or text[a] in "+("):
                        a += 1
                    while a < z and not text[z - 1].isalnum():
                        z -= 1
                    if z - a >= SHORTEST and float(sure[a:z].mean()) >= SURE and plausible(kind, text[a:z]):
                        spans.append((int(a), kind, int(z)))
        out.append(spans)
    return out


def all_spans(m: dict, texts: list[str]) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind, end, base) of each text, sorted by start, then kind."""
    out = []
    for text, added in zip(texts, model_spans(m, texts) if texts else [], strict=True):
        base = base_spans(text)
        new = [s for s in added if all(s[2] <= a or b <= s[0] for a, _, b in base)]
        out.append(sorted([(*s, True) for s in base] + [(*s, False) for s in new]))
    return out


def _train_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, starts, kinds, ends = [], [], [], []
        for text in batch["text"].to_pylist():
            text = text or ""
            spans = base_spans(text)
            step = max(1, len(spans) // WINDOWS)
            centres = [(a + b) // 2 for a, _, b in spans[::step][:WINDOWS]] or [len(text) * (2 * i + 1) // (2 * WINDOWS) for i in range(WINDOWS)]
            for c in sorted(set(centres)):
                lo = max(0, c - TRAIN_LENGTH)
                piece = text[lo : lo + 2 * TRAIN_LENGTH]
                own = base_spans(piece)
                out.append(piece)
                starts.append([a for a, _, _ in own])
                kinds.append([k for _, k, _ in own])
                ends.append([b for _, _, b in own])
        lists = [pa.array(v, pa.list_(pa.int64())) for v in (starts, kinds, ends)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *lists], names=["text", "starts", "kinds", "ends"])


def train(docs: DataFrame, limit: int = TRAIN_DOCS) -> dict:
    """Fit on windows of at most ``limit`` texts, half of them with an @ or a digit."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("h")).filter("text <> ''")
    marks = texts.select("h", (F.contains("text", F.lit("@")) | F.col("text").rlike("[0-9]{3}")).alias("marked"))
    half = lambda on: marks.filter(F.col("marked") == on).select("h").distinct().orderBy("h").limit(limit // 2)
    chosen = half(True).unionByName(half(False))
    # Rows that repeat a doc_id and text are one: at most ``limit`` texts go on.
    once = texts.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("text").alias("text"))
    got = once.select("text").mapInArrow(
        _train_windows, "text string, starts array<long>, kinds array<long>, ends array<long>"
    ).orderBy("text").collect()  # at most limit * WINDOWS short windows
    return fit([(r["text"], list(zip(r["starts"], r["kinds"], r["ends"], strict=True))) for r in got])


def with_spans(docs: DataFrame, model: dict, into: str = "pii") -> DataFrame:
    """``docs`` with array (start, kind, end, base) in column ``into``."""

    @F.arrow_udf("array<struct<start:long,kind:string,end:long,base:boolean>>")
    def spans(text: pa.Array) -> pa.Array:
        values, kind = [], pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("base", pa.bool_())]))
        lo = 0
        while lo < len(text):
            # Runs of about a megabyte of text.
            some, size = [], 0
            while lo < len(text) and size < BATCH_CHARS:
                some.append(text[lo].as_py() or "")
                size += len(some[-1])
                lo += 1
            values += [[{"start": a, "kind": KINDS[k], "end": b, "base": base} for a, k, b, base in own] for own in all_spans(model, some)]
        return pa.array(values, kind)

    return docs.withColumn(into, spans(F.col("text").cast("string")))


def op7_bilstm_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs, train(docs)).select("doc_id", "pii", F.filter("pii", lambda s: s["base"]).alias("base"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("pii").alias("spans"),
        (F.size("pii") - F.size("base")).cast("long").alias("n_model"),
    )
