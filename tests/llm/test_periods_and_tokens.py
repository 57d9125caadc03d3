"""Operators 11 to 13 against brute force and against the tokenizers' own libraries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from filingfold.llm import alignment, periods, token_machine
from filingfold.llm.textkernel import mix64
from tests.llm.helpers import SF, empty_docs, odd_docs, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ periodic runs


def brute_runs(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b, q) for (a, b), q in found.items())


def brute_row(doc_id, text, least=12):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [(a, b - a, q) for a, b, q in brute_runs(words, least)]
    dropped = {i for a, m, q in runs for i in range(a + q, a + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    runs.sort(key=lambda r: (r[0], r[2]))
    return (
        doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
        sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def random_words(rng):
    n, k = rng.randrange(70), rng.choice([1, 2, 2, 3, 4])
    words = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.5:
        p = rng.randrange(1, n + 1)
        words = [words[i % p] for i in range(n)]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(n)] = rng.randrange(k)
    return words


def hashed(words):
    return mix64(np.array(words, np.uint64) + np.uint64(77))


def test_squares_are_caught_whole_and_word_by_word():
    rng = random.Random(5)
    for _ in range(600):
        words, least = random_words(rng), rng.choice([2, 4, 12])
        whole, online, at = periods.SquareCatcher(), periods.SquareCatcher(), 0
        whole.append(hashed(words))
        assert [tuple(r) for r in whole.runs(least).tolist()] == brute_runs(words, least)
        while at < len(words):
            step = rng.choice([1, 1, 1, 2, 5, 17])
            online.append(hashed(words[at : at + step]))
            at += step
            if rng.random() < 0.3:
                assert [tuple(r) for r in online.runs(least).tolist()] == brute_runs(words[:at], least)
        assert online.runs(least).tolist() == whole.runs(least).tolist()


def test_texts_of_a_batch_do_not_touch():
    rng = random.Random(6)
    texts = [random_words(rng) for _ in range(200)]
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    text, found = periods.runs_of(hashed([w for t in texts for w in t]), bounds)
    got = [[] for _ in texts]
    for i, run in zip(text.tolist(), found.tolist(), strict=True):
        got[i].append(tuple(run))
    assert got == [brute_runs(t) for t in texts]


def test_one_word_many_times():
    catcher = periods.SquareCatcher()
    catcher.append(hashed([3] * 100_000))
    assert catcher.runs().tolist() == [[0, 100_000, 1]]


def test_op11_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: brute_row(r.doc_id, r.text) for r in rows if len(r.text or "") < 4000}
    got = {r.doc_id: tuple(r) for r in periods.op11_dyadic_runs(spark, SF).collect()}
    assert len(got) == len(rows) and any(r[1] for r in short.values())
    assert {i: got[i] for i in short} == short


def test_op11_defined_cases(spark):
    docs = odd_docs(spark)
    got = periods.find_runs(docs).collect()
    assert len(got) == docs.count()
    key = lambda r: (str(r[0]), r[1])
    want = [(r[0], brute_row(None, r[1])) for r in odd_rows() if len(r[1] or "") < 3000]
    want = sorted(((i, r[-1]) for i, r in want), key=key)
    seen = sorted(((r.doc_id, sha(r.collapsed)) for r in got if r.doc_id not in (10, 11)), key=key)
    assert seen == want
    assert next(r for r in got if r.doc_id == 13).runs[0].period == 4
    assert periods.find_runs(empty_docs(spark)).count() == 0


# ------------------------------------------------------------------ token machine


@pytest.fixture(scope="module")
def machine():
    return token_machine.Machine(token_machine.read_vocabulary(public_tokenizers.path(token_machine.VOCABULARY)))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(token_machine.VOCABULARY))
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(machine, library):
    rng = random.Random(3)
    signs = "abcdefgin' re's1.,!é 日😀ßxX\t\n"
    texts = [
        "hello world", "it's they're I'll we've 'sun 'r 're 'v 'll'l", "", "   ", "a'b''s'", "1234 ab12cd", "ΑΣ Σ ΟΔΥΣΣΕΥΣ İstanbul ſ ß",
        "x<|endoftext|>y <|EndOfText|> <|startoftext|>z <|endoftext|̸>", "日本語 テスト 😀😀 ²½ ٣٤ á", "x" * 5000, "ab" * 900, "'" * 700, "7" * 90,
    ]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["".join(rng.choice("aeinorstl") for _ in range(rng.randrange(300))) for _ in range(300)]
    assert machine.counts(texts).tolist() == library(texts)


def test_every_character(machine, library):
    texts = ["a" + chr(c) + "b" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    assert machine.counts(texts).tolist() == library(texts)


def test_few_states_give_the_same_counts(library):
    spec = token_machine.read_vocabulary(public_tokenizers.path(token_machine.VOCABULARY))
    small, rng = token_machine.Machine(spec, most=300), random.Random(4)
    texts = ["".join(rng.choice("aeinorst  ,é") for _ in range(rng.randrange(200))) for _ in range(200)]
    for lo in range(0, len(texts), 10):
        assert small.counts(texts[lo : lo + 10]).tolist() == library(texts[lo : lo + 10])
    assert len(small.states) < 1000


def test_op12_equals_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text or "" for r in rows]
    want = [(r.doc_id, len(t.encode()), n, n > 2048) for r, t, n in zip(rows, texts, library(texts), strict=True)]
    assert sorted(map(tuple, token_machine.op12_machine_counts(spark, SF).collect())) == sorted(want)


def test_op12_defined_cases(spark, library):
    path = public_tokenizers.path(token_machine.VOCABULARY)
    got = token_machine.count_tokens(odd_docs(spark), path).collect()
    texts = [r[1] or "" for r in odd_rows()]
    want = [(r[0], len(t.encode()), n) for r, t, n in zip(odd_rows(), texts, library(texts), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_machine.count_tokens(empty_docs(spark), path).count() == 0


# ------------------------------------------------------------------ alignment


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path(alignment.A_TOKENS))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.B_MODEL))
    alphabet = token_machine.byte_alphabet()
    documents, out = Counter(), []
    for doc_id, text in rows:
        ia = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        ba = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x..>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ib)]
        if not text or b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            out.append((doc_id, 0, 0, 0, Counter(), ""))
            continue
        ends = [set(np.cumsum([len(x) for x in t]).tolist()) for t in (ba, bb)]
        common = sorted(ends[0] & ends[1])
        links, said, i, j, pa, pb = Counter(), [], 0, 0, 0, 0
        for c in common:
            ga, gb = [], []
            while pa < c:
                ga.append(ia[i])
                pa += len(ba[i])
                i += 1
            while pb < c:
                gb.append(ib[j])
                pb += len(bb[j])
                j += 1
            links.update((x, y) for x in ga for y in gb)
            said.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        documents.update(links.keys())
        out.append((doc_id, len(ia), len(ib), len(common), links, sha(";".join(said))))
    top = Counter()
    for (x, _), n in documents.items():
        top[x] = max(top[x], n)
    return [
        (d, na, nb, ng, sum(k.values()), sum(n for p, n in k.items() if documents[p] == top[p[0]]), sum(n * documents[p] for p, n in k.items()), s)
        for d, na, nb, ng, k, s in out
    ]


@pytest.mark.parametrize("most", [0, 10**6])
def test_op13_equals_brute_force(spark, most):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = alignment.op13_galloping_alignment(spark, SF, most=most)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_alignment(rows))


def test_op13_defined_cases(spark, tmp_path):
    odd = odd_docs(spark)
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    extra = spark.createDataFrame([(20, "<|endoftext|> <s> ▁ here"), (21, "a  b▁c"), (22, "   ﬁ ½ ①"), (23, "日本語" * 50)], "doc_id long, text string")
    extra.write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    rows = [(r[0], r[1]) for r in odd_rows()] + [tuple(r) for r in extra.collect()]
    got = alignment.op13_galloping_alignment(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_alignment(rows)))
    empty_docs(spark).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert alignment.op13_galloping_alignment(spark, f"{tmp_path}/none").count() == 0


def test_galloping_finds_common_ends():
    rng = np.random.default_rng(2)
    lists = [[np.sort(rng.choice(5000, rng.integers(0, m), replace=False)) for m in (900, 90)] for _ in range(50)]
    lists = [p if i % 2 else p[::-1] for i, p in enumerate(lists)]
    a, b = (np.concatenate([p[k] + 10_000 * i for i, p in enumerate(lists)]) for k in (0, 1))
    bounds = [np.append(0, np.cumsum([len(p[k]) for p in lists])) for k in (0, 1)]
    at_a, at_b = alignment.common_ends(a, bounds[0], b, bounds[1])
    assert (a[at_a] == b[at_b]).all() and a[at_a].tolist() == np.intersect1d(a, b).tolist()


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    x = {
        "a": np.array([1, 1, 2, 3]), "b": np.array([7, 8, 8, 9]), "a_bounds": np.array([0, 4]), "b_bounds": np.array([0, 4]),
        "stop_a": np.array([3, 4]), "stop_b": np.array([3, 4]), "groups": np.array([0, 2]),
    }
    plain = [v.tolist() for v in alignment.links_of(x)]
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    assert [v.tolist() for v in alignment.links_of(x)] == plain
    assert plain[2:] == [[0, 5], [10]] and sum(plain[1]) == 10
