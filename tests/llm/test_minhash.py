from __future__ import annotations

import random

import numpy as np
import pytest

from filingfold.llm import minhash as M
from filingfold.llm.textkernel import Words, runs, shingles
from tests.llm.helpers import SF, DOCS, components, odd_docs, odd_rows, pairs_at_least, shingle_set


def brute(rows, k, percent):
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets.setdefault(doc_id, shingle_set(text, k))
    return sets, components(sets, pairs_at_least(sets, percent))


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_groups_equal_brute_force(spark, k, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets, want = brute([(r.doc_id, r.text) for r in docs.collect()], k, percent)
    got = M.near_duplicates(docs, k, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(s) for d, s in sets.items()}


def test_edited_copies_chains_and_shared_passages(spark):
    """Copies of an original that link only through it, chains, and texts that share a
    long passage without being copies."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(100_000)}"
    rows, original = [], [word() for _ in range(400)]
    rows.append(" ".join(original))
    for _ in range(60):
        copy = list(original)
        for _ in range(8):
            copy[rng.randrange(400)] = word()
        rows.append(" ".join(copy))
    step = [word() for _ in range(300)]
    for _ in range(12):
        rows.append(" ".join(step))
        step = step[6:] + [word() for _ in range(6)]
    passage = [word() for _ in range(120)]
    rows += [" ".join(passage + [word() for _ in range(60)]) for _ in range(60)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(rows)], DOCS)
    _, want = brute(list(enumerate(rows)), 3, 85)
    assert len(set(want.values())) < len(rows) - 60
    assert {r.doc_id: r.component_id for r in M.near_duplicates(docs, 3, 85).collect()} == want


@pytest.mark.parametrize("second", ["same", "other"])
def test_repeated_rows_in_buckets_of_several_components(spark, second):
    """Each variant of a text links with many; an edited copy of one variant links only
    with that one, and its row is repeated, or its doc_id has another text of that size."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**9)}" for _ in range(100)]
    rows = []
    for v in range(64):
        text = list(base)
        for bit in range(6):
            if v >> bit & 1:
                text[10 + 8 * bit] = f"alt{bit}"
        rows.append((v, " ".join(text)))
        if v % 3 == 0:
            text[70], text[85] = f"own{v}", f"also{v}"
            rows.append((100 + v, " ".join(text)))
            rows.append((100 + v, " ".join(text if second == "same" else [f"x{v}y{i}" for i in range(100)])))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = M.near_duplicates(docs, 3, 85).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {0}


def test_odd_rows(spark):
    got = M.near_duplicates(odd_docs(spark), 3, 85).collect()
    assert len(got) == len(odd_rows())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    _, want = brute([(r[0], r[1]) for r in odd_rows()], 3, 85)
    assert {d: r.component_id for d, r in by_id.items()} == want
    assert by_id[4].n_shingles == 0 and by_id[5].n_shingles == 0 and by_id[6].n_shingles == 0
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_keep_one(spark):
    kept = M.keep_one_of_each(odd_docs(spark), 3, 85)
    assert kept.columns == odd_docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert 2 not in ids and 3 not in ids and 8 not in ids and ids.count(None) == 2 and {1, 4, 5, 6, 7} <= set(ids)


def test_permutations_are_bijections_and_coordinates_estimate_similarity():
    low = np.arange(1 << 16, dtype=np.uint32)
    for odd in (M.SIGMA, M.PI):
        assert len(np.unique(M.permute(low.copy(), odd))) == 1 << 16
    rng = np.random.default_rng(0)
    both = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    errors = []
    for _ in range(40):
        both = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
        a, b = M.signature(both[:500], 240), M.signature(both[100:], 240)
        errors.append((a == b).mean() - 400 / 600)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_kernel_words_and_shingles():
    texts = ["One  two\tTHREE four", "", "ab", " x y ", "Äb c"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words = Words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    got = [[bytes(words.data[words.start[j] : words.end[j]]).decode() for j in range(words.bounds[i], words.bounds[i + 1])] for i in range(5)]
    assert got == [["one", "two", "three", "four"], [], ["ab"], ["x", "y"], ["Äb", "c"]]
    assert list(runs(offsets, 5)) == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert len(shingles(words.hash[:4], 3)) == 2 and len(shingles(words.hash[4:5], 3)) == 1
