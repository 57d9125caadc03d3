from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from filingfold.llm import language as G
from filingfold.llm import pii as P
from filingfold.llm import quality as Q
from tests.llm.helpers import DOCS, empty_docs, labels, odd_docs, odd_rows

SF01 = "/root/testdata/sf0.01"


# --- language ---------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    rows = G.op3_crf_language(spark, SF01).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out and truth[r.doc_id] is not None]
    assert len(held) > 100 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(2)
    bounds = np.array([0, 3, 3, 4, 9])
    e, move, start = rng.normal(size=(9, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got = G.posteriors(e, bounds, move, start)
    for a, b in itertools.pairwise(bounds):
        if a == b:
            continue
        total = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            s = start[path[0]] + sum(e[a + t, y] for t, y in enumerate(path)) + sum(move[x, y] for x, y in itertools.pairwise(path))
            for t, y in enumerate(path):
                total[t, y] += np.exp(s)
        assert np.allclose(got[a:b], total / total.sum(1, keepdims=True), atol=1e-4)


def test_code_switched_text_is_labelled_by_word(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = G.train(docs)
    by = {lang: next(r.text for r in docs.filter(docs.lang == lang).orderBy("doc_id").collect() if len(r.text.split()) > 60) for lang in ("en", "de")}
    text = " ".join(by["en"].split()[:40] + by["de"].split()[:40])
    data, offsets = G.text_buffers(pa.array([text]))
    words = G.Words(G.fold_case(data), offsets, G.LETTER)
    gamma = G.posteriors(G.word_emissions(model, words), words.bounds, model["transitions"], model["start"])
    best = [model["langs"][i] for i in gamma.argmax(1)]
    assert np.mean([x == "en" for x in best[:38]]) > 0.9 and np.mean([x == "de" for x in best[-36:]]) > 0.9


def test_language_odd_rows(spark):
    docs = odd_docs(spark)
    out = G.with_language(docs, G.train(docs))
    assert out.columns == [*docs.columns, "language"]
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append(r.language)
    assert sum(map(len, by.values())) == len(odd_rows())
    for i in (4, 5, 6, 9):
        assert by[i][0].lang == "und" and by[i][0].score == 0
    assert by[2][0] == by[2][1] and all(x.lang in ("en", "de", "fr", "und") for v in by.values() for x in v)
    assert G.label_texts({"langs": []}, pa.array(["hello"]))[0] == ["und"]
    assert G.with_language(empty_docs(spark), G.train(empty_docs(spark))).count() == 0
    marks = G.label_texts(G.train(docs), pa.array(["“—” €", "12 34", None, "東京"]))[0]
    assert marks[:3] == ["und"] * 3 and marks[3] != "und"


# --- quality ----------------------------------------------------------------
def test_quality_held_out(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = Q.op8_attention_quality(spark, SF01).collect()
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == 1000 and len(held) > 30 and np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_gradient():
    rng = np.random.default_rng(0)
    x, bounds, y = rng.normal(size=(9, Q.N_FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    m = {k: rng.normal(0, 0.4, s) for k, s in (
        ("We", (Q.N_FEATURES, Q.HIDDEN)), ("be", Q.HIDDEN), ("V", (Q.HIDDEN, Q.ATTENTION)), ("U", (Q.HIDDEN, Q.ATTENTION)),
        ("w", Q.ATTENTION), ("c", Q.HIDDEN), ("b", 1))}

    def loss():
        p = Q.forward(m, x, bounds)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, g in Q.gradients(m, x, bounds, y).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = m[name][at]
        m[name][at] = old + 1e-5
        up = loss()
        m[name][at] = old - 1e-5
        assert g[at] == pytest.approx((up - loss()) / 2e-5, rel=1e-3)
        m[name][at] = old


def test_quality_odd_rows(spark):
    docs = odd_docs(spark)
    marks = labels(spark, [(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, 1), (None, 1, 0), (12, 1, 0), (10, 0, 0), (11, 0, 0), (14, 1, 0)])
    out = Q.with_quality(docs, Q.train(docs, marks))
    rows = out.collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert Q.keep_good(docs, marks).columns == docs.columns
    assert Q.train(docs, labels(spark)) == {"prior": 0.5}
    assert Q.keep_good(empty_docs(spark), labels(spark)).count() == 0


# --- personal data ----------------------------------------------------------
def naive(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group())
        if 14 <= len(d) <= 19 and P.luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_rules_equal_the_patterns():
    rng = np.random.default_rng(6)
    alphabet = list("a.-@+()0123456789 4%_é")
    texts = ["".join(rng.choice(alphabet, 60)) for _ in range(3000)]
    texts += ["a@b.c.d@e.f", "x@@y.z", "1.2.3.4.5.6.7.8", "001.2.3.255", "4111 1111 1111 1111 1", "+1 (212) 555-0199-", "4111-1111-1111-1111", "+12++34567890123"]
    for t in texts:
        assert P.base_spans(t) == naive(t), t
    assert P.base_spans("1" * 200_000 + "@" + "a" * 200_000) == []


def test_lstm_gradient_and_decoding():
    rng = np.random.default_rng(1)
    texts = [("the quick brown fox jumps over it and goes. Then he was there again at noon " * 2, [])]
    x, y = P.training_set(texts, rng, 64)
    m = P.fit(texts, steps=40)
    x1, y1 = x[:16, :3], y[:16, :3]

    def loss():
        e, total = P.emissions(m, x1).astype(float), 0.0
        for j in range(3):
            a, s = e[0, j] + m["start"], e[0, j, y1[0, j]] + m["start"][y1[0, j]]
            for t in range(1, 16):
                a = np.log(np.exp(a[:, None] + m["move"]).sum(0)) + e[t, j]
                s += m["move"][y1[t - 1, j], y1[t, j]] + e[t, j, y1[t, j]]
            total += np.log(np.exp(a).sum()) - s
        return total / 3

    hf, keep = P.lstm(x1, m["embed_f"], m["recur_f"], keep=True)
    hb = P.lstm(x1[::-1], m["embed_b"], m["recur_b"])[::-1]
    e = hf @ m["out_f"] + hb @ m["out_b"] + m["bias"]
    assert np.allclose(e, P.emissions(m, x1), atol=1e-4)
    d, d_move, _ = P.crf_gradient(e, y1, m["move"], m["start"])
    d_embed, d_recur = P.lstm_gradient(x1, m["recur_f"], keep, d @ m["out_f"].T, P.N_CLASSES)
    for name, g in (("recur_f", d_recur), ("embed_f", d_embed), ("move", d_move)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = m[name][at]
        m[name][at] = old + 1e-2
        up = loss()
        m[name][at] = old - 1e-2
        assert g[at] == pytest.approx((up - loss()) / 2e-2, rel=0.05, abs=1e-3)
        m[name][at] = old
    # Windows that are skipped are exactly "none" under Viterbi.
    e = P.emissions(m, x)
    best = P.viterbi(e, m["move"], m["start"])
    assert not (best.any(0) & ~P.may_hold_spans(e, m["move"], m["start"])).any()
    labels_, _ = P.decode(m, x)
    assert (labels_ == best).all()
    few = P.viterbi(e[:5, :4], m["move"], m["start"])
    for j in range(4):
        score = lambda p: m["start"][p[0]] + sum(e[t, j, k] for t, k in enumerate(p)) + sum(m["move"][a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        assert score(tuple(few[:, j])) == pytest.approx(max(map(score, itertools.product(range(5), repeat=5))), rel=1e-4)


def test_pii_query_and_model(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    model = P.train(docs)
    extra = [(1, "please call (212) 555-0134 before noon or write to jane.doe@example.org now"), (2, "x" * 5000 + " mail bob@example.com " + "y" * 300)]
    rows = P.with_spans(spark.createDataFrame(extra, "doc_id long, text string"), model).collect()
    got = {r.doc_id: [(s.kind, s.base) for s in r.pii] for r in rows}
    assert ("email", True) in got[1] and ("email", True) in got[2]
    found = P.op7_bilstm_pii(spark, SF01).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    recall = []
    for r in found:
        base = naive(text[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        own = [f"{P.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert set(own) <= set(r.spans.split(",")) | {""}
        assert r.n_model == len([s for s in r.spans.split(",") if s]) - len(own)
    # The model by itself finds nearly all base spans.
    for r in docs.collect():
        if base := naive(r.text or ""):
            mine = P.model_spans(model, [r.text])[0]
            recall += [any(k == k2 and a < z and b < e for a, k2, e in mine) for b, k, z in base]
    assert np.mean(recall) > 0.85


def test_pii_odd_rows(spark):
    docs = odd_docs(spark)
    model = P.fit([], steps=3)
    out = P.with_spans(docs, model)
    assert out.columns == [*docs.columns, "pii"]
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert [(s.start, P.KINDS.index(s.kind), s.end) for s in r.pii if s.base] == naive(r.text or "")
    assert P.with_spans(empty_docs(spark), model).count() == 0
    assert set(P.train(empty_docs(spark))) == set(model)


def test_training_reads_a_bounded_number_of_texts(spark, monkeypatch):
    """One doc_id on 5,000 rows, with different and with equal texts."""
    seen = {}
    for module, count in ((G, lambda got: len(got)), (P, lambda got: len(got)), (Q, lambda got, y: len(got))):
        monkeypatch.setattr(module, "fit", lambda *a, m=module, c=count, f=module.fit, **k: (seen.setdefault(m, c(*a)), f(*a, **k))[1])
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2 and zlib.crc32(str(i).encode()) % 5)
    word = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    rows = [(one, f"the house of {word(i)} is old and the river is near 555" * 8, "en", None, None) for i in range(2500)]
    rows += [(one, "the same words again and again", "en", None, None)] * 2500
    docs = spark.createDataFrame(rows, DOCS)
    model = G.train(docs, limit=50)
    assert seen[G] <= 50 * G.SEGMENTS and model["langs"] == ["en"]
    same = spark.createDataFrame(rows[-200:], DOCS)
    assert G.train(same, limit=5)["langs"] == ["en"]
    P.train(docs, limit=20)
    assert 0 < seen[P] <= 20 * P.WINDOWS
    Q.train(docs, labels(spark, [(one, 1, 0)]), limit=10)
    assert seen[Q] == 1


def test_the_model_finds_what_the_rules_miss(spark):
    """Phones without country code and spelled-out addresses, set into clean text."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = P.train(docs)
    clean = [r.text for r in docs.filter("length(text) > 400").orderBy("doc_id").limit(300).collect() if not P.base_spans(r.text) and not re.search("[0-9@]", r.text)]
    planted, n = [], 0
    for i, text in enumerate(clean[:100]):
        at = text.find(" ", 150)
        planted.append(f"{text[:at]} {['(212) 555-0134', 'jane.doe(at)example.org', '(647) 203-7781'][i % 3]} {text[at + 1 :]}")
    found = P.model_spans(model, planted)
    hits = sum(any(s[0] <= 152 + 200 and s[1] in (0, 3) for s in spans) for spans in found)
    false = sum(map(len, P.model_spans(model, clean)))
    assert len(planted) >= 50 and hits >= 0.8 * len(planted), (hits, len(planted))
    assert false <= 0.02 * len(clean), (false, len(clean))
    assert all(not P.base_spans(t) for t in planted)
