from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from filingfold.llm import license_scan as L
from filingfold.llm import line_templates as T
from tests.llm.helpers import DOCS, SF, empty_docs, odd_docs, odd_rows


def brute_lines(rows, min_docs=T.MIN_DOCS, similarity=T.SIMILARITY):
    """(n_lines, n_dropped, clean_text) per row, with plain dictionaries."""
    def parse(line):
        tokens = [t for t in re.split(r"[\x20\x09-\x0D]+", line) if t]
        return tuple("<*>" if re.search("[0-9]", t) else t for t in tokens) if len(tokens) >= T.MIN_TOKENS else None

    docs_of, leaf_docs = defaultdict(set), defaultdict(set)
    for doc_id, text in rows:
        for line in (text.split("\n") if text is not None else []):
            if mask := parse(line):
                docs_of[mask].add((doc_id, text))
                leaf_docs[(len(mask), mask[: T.LEAD])].add((doc_id, text))
    leaves = defaultdict(list)
    for mask in docs_of:
        leaves[(len(mask), mask[: T.LEAD])].append(mask)
    drop = set()
    for leaf, masks in leaves.items():
        if len(leaf_docs[leaf]) < min_docs:
            continue
        drop |= {m for m in masks if len(docs_of[m]) >= min_docs}

        def take(group):
            template = []
            for i in range(leaf[0]):
                votes = Counter()
                for m in group:
                    votes[m[i]] += len(docs_of[m])
                top = max((n, t) for t, n in votes.items())
                template.append(top[1] if 2 * top[0] >= sum(votes.values()) else "<*>")
            fits = [m for m in group if sum(a == b for a, b in zip(m, template)) >= similarity * leaf[0]]
            return fits if fits and len(set().union(*(docs_of[m] for m in fits))) >= min_docs else []

        first = take(masks)
        drop |= set(first)
        rest = [m for m in masks if m not in set(first)]
        places = []
        for i in range(leaf[0]):
            votes = Counter()
            for m in rest:
                votes[m[i]] += len(docs_of[m])
            if len(votes) > 1 and max(votes.values()) >= min_docs:
                places.append((len(votes), i))
        if places:
            groups = defaultdict(list)
            for m in rest:
                groups[m[min(places)[1]]].append(m)
            for group in groups.values():
                drop |= set(take(group))
    out = []
    for doc_id, text in rows:
        if text is None:
            out.append((doc_id, 0, 0, None))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if parse(x) not in drop]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def lines_of(spark, docs):
    return sorted((tuple(r) for r in T.drop_recurring(docs).select("doc_id", "n_lines", "n_dropped", "clean_text").collect()), key=repr)


def test_op5_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute_lines([tuple(r) for r in docs.collect()])
    assert sum(r[2] for r in want) > 0
    assert sorted((tuple(r) for r in T.op5_line_templates(spark, SF).collect()), key=repr) == want


def test_variable_fields_are_generalised(spark):
    names = ["Anna", "Bert", "Carla", "Dirk", "Emma", "Fritz"]
    rows = [(i, f"own line of text number {'abcdef'[i]} here\nPosted by user {n} on day {i} at noon\nunrelated {n} {n}x words {n}y") for i, n in enumerate(names)]
    rows.append((9, "Posted by user something else entirely different here today"))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = lines_of(spark, docs)
    assert got == brute_lines(rows)
    by = {r[0]: r for r in got}
    assert all("Posted" not in by[i][3] and "unrelated" in by[i][3] for i in range(6)) and by[9][2] == 0


def test_short_lines_that_recur_are_dropped(spark):
    """Lines of one and two tokens in five documents go, in four they stay, as do blank lines."""
    texts = [f"Read more\nPage {i}\nMenu\n \n\ntext of {'abcdef'[i]}" + ("\nLog in\nHelp" if i < 4 else "") for i in range(6)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = lines_of(spark, docs)
    assert got == brute_lines(list(enumerate(texts)))
    for i, n, dropped, kept in got:
        assert dropped == 3 and kept.split("\n") == [" ", "", f"text of {'abcdef'[i]}"] + (["Log in", "Help"] if i < 4 else [])


@pytest.mark.parametrize("forms", [1, 2, 3])
def test_several_templates_in_one_leaf(spark, forms):
    """No form has a majority in the leaf; a single line of the leaf and a form in four documents stay."""
    ends = ["was created on server", "has been locked out", "got its password reset"][:forms]
    lines = [f"the user account {'abcdefgh'[i] * (j + 2)} {end}" for j, end in enumerate(ends) for i in range(7)]
    stay = ["the user account of nobody is kept here"] + [f"the user account {'abcd'[i] * 9} may never be seen" for i in range(4)]
    texts = [f"{x}\ntext {'abcdefghijklmnopqrstuvwxyz'[i]}" for i, x in enumerate(lines + stay)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = {r[0]: r[2] for r in lines_of(spark, docs)}
    assert got == {i: int(i < len(lines)) for i in range(len(texts))}


def test_a_common_field_value_does_not_hide_templates(spark):
    """The field value 'root' is the leaf's most frequent token, but every form is found."""
    ends = ["was created on server", "has been locked out", "got its password reset"]
    lines = [f"the user account {'root' if i < 3 else 'abcdefgh'[i] * (j + 2)} {end}" for j, end in enumerate(ends) for i in range(6)]
    docs = spark.createDataFrame([(i, x, None, None, None) for i, x in enumerate(lines)], DOCS)
    assert all(r[2] == 1 for r in lines_of(spark, docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_leaves_equal_brute_force(spark, seed):
    """Few leaves with many lines: majority templates, split groups and rare lines."""
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        lines = []
        for _ in range(rng.randrange(6)):
            form = [["job", "alpha", "has"], ["job", "beta", "has"], ["a", "b", "c"]][rng.randrange(3)]
            tail = [rng.choice("pqrstu") if rng.random() < 0.5 else rng.choice(["ended", "begun", "x7", "zz"]) for _ in range(rng.randrange(3, 6))]
            lines.append(rng.choice(["", " ", "\t"]) + rng.choice([" ", "  "]).join(form + tail))
        rows.append((i, "\n".join(lines) if i % 50 else None))
    rows += rows[:20]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got, want = lines_of(spark, docs), brute_lines(rows)
    assert got == want and 0 < sum(r[2] for r in want) < sum(r[1] for r in want)


def test_many_lines_in_one_text(spark):
    """Removal is linear in the lines of a text."""
    long = "\n".join("read more here" if i % 2 else f"line {'abcdefghij'[i % 10] * (1 + i // 10)}" for i in range(30_000))
    texts = [long] + ["read more here"] * 5
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = {r[0]: (r[1], r[2]) for r in lines_of(spark, docs)}
    assert got[0] == (30_000, 15_000) and got[1] == (1, 1)


def test_line_odd_rows(spark):
    docs = odd_docs(spark)
    out = T.drop_recurring(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped", "clean_text"]
    assert same_rows(out.select(docs.columns), docs) and same_rows(L.scan(docs).select(docs.columns), docs)
    assert lines_of(spark, docs) == brute_lines([(r[0], r[1]) for r in odd_rows()])
    assert T.drop_recurring(empty_docs(spark)).count() == 0


def same_rows(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_matches(text, base=L.BASE, templates=L.TEMPLATES):
    w, out = words(text), []
    for phrase, label in base.items():
        p = phrase.split()
        out += [(label, i, i + len(p), 1.0, True) for i in range(len(w)) if w[i : i + len(p)] == p]
    for phrase, label in templates.items():
        p = phrase.split()
        for i in range(len(w)):
            share = len(set(w[i : i + len(p)]) & set(p)) / len(set(p))
            if share >= L.THRESHOLD:
                out.append((label, i, min(len(w), i + len(p)), share, False))
    return sorted(out)


@pytest.mark.parametrize("which", ["data", "odd", "made"])
def test_license_matches_equal_brute_force(spark, which):
    if which == "data":
        docs = spark.read.parquet(f"{SF}/documents.parquet")
    elif which == "odd":
        docs = odd_docs(spark)
    else:
        texts = [
            "Under the MIT License, under the\nmit   license", "licensed under the GNU general public LICENSE v 3 this work is", "all rights are reserved",
            "Permission is granted, free of charge, to any person obtaining a copy of such software", "cc-by-nc by nc cc", "Apache License; Version 2.0",
            "license version 2 apache license version 2 apache", "is distributed on an as is basis unless required by applicable law or agreed to in writing",
        ]
        docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = L.scan(docs).select("text", "n_words", "matches").collect()
    for r in got:
        assert r.n_words == len(words(r.text))
        assert sorted((m.label, m.first_word, m.end_word, round(m.containment, 9), m.base) for m in r.matches) == [
            (a, b, c, round(d, 9), e) for a, b, c, d, e in brute_matches(r.text)
        ]
    if which == "made":
        assert sum(bool(r.matches) for r in got) >= 6


def test_op9_columns(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in L.op9_license_scan(spark, SF).collect():
        base = [m for m in brute_matches(docs[r.doc_id]) if m[4]]
        assert r.n_base == len(base) and r.first_word == min((m[1] for m in base), default=None) and r.last_word == max((m[1] for m in base), default=None)
        assert r.base_labels == ",".join(sorted({m[0] for m in base})) and 0 <= r.score <= 1
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}


def test_license_empty(spark):
    assert L.scan(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_random_template_tables_equal_brute_force(spark, seed):
    """Repeated words in templates and blocks, ties of frequency, blocks at the ends of texts."""
    rng = random.Random(seed)
    letters = "abcdefghij"
    phrase = lambda: " ".join(rng.choice(letters) for _ in range(rng.randrange(1, 9)))
    base = {phrase(): f"base{i}" for i in range(4)}
    templates = {p: f"t{i}" for i, p in enumerate({phrase() for _ in range(12)} - set(base))}
    texts = [" ".join(rng.choice(letters + "XYZ") for _ in range(rng.randrange(40))) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    table = L.template_table(spark, base, templates)
    for r in L.scan(docs, table).select("text", "matches").collect():
        got = sorted((m.label, m.first_word, m.end_word, round(m.containment, 9), m.base) for m in r.matches)
        assert got == [(a, b, c, round(d, 9), e) for a, b, c, d, e in brute_matches(r.text, base, templates)]


def test_each_filter_drops_blocks_and_no_match(spark):
    """Rows after the prefix, the length, the first-word, the positional filter and the verification."""
    phrases = [("t", "a b c d e f g h i j", False), ("u", "k l m n o p q r s x", False)]
    listed = [(label, p.split(), exact) for label, p, exact in phrases]
    vocabulary = sorted({w for _, ws, _ in listed for w in ws})
    probes, rows = L.index(listed, {w: i + 1 for i, w in enumerate(vocabulary)}, 0.8)
    texts = [
        "a b c d e f g h i j", "z z c d e f g h i j b a", "a z z z z z z z z z", "c a b k l m n o p q r s x z",
        "d e f a k l m n b g h i c", "c d e f g h i j z z",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select("id", L.words_of(L.F.col("text")).alias("words"))
    found = docs.select("id", L.F.explode(L.hits(sorted({w for w, _, _ in probes}), vocabulary, 10, 8)).alias("hit")).select("id", "hit.*")
    met = L.candidates(found, spark.createDataFrame(probes, L.PROBE_SCHEMA), spark.createDataFrame(rows, L.TEMPLATE_SCHEMA))
    steps = [L.blocks_at(met, vocabulary)]
    for step in (L.by_length, L.by_first_word, L.by_position, L.verified):
        steps.append(step(steps[-1]))
    counts = [x.count() for x in steps]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[1] > counts[2] > counts[3] > counts[4] > 0
    want = [(i, s) for i, t in enumerate(texts) for _, s, *_ in brute_matches(t, {}, {p: label for label, p, _ in phrases})]
    assert sorted((r.id, r.s) for r in steps[-1].select("id", "s").collect()) == sorted(want)


def test_template_table_bounds_and_odd_templates(spark, monkeypatch):
    docs = odd_docs(spark)
    table = spark.createDataFrame(
        [("none", None, True), ("blank", " -- ", False), ("m", "Under the MIT-License!", None), (None, "river", True)], "label string, phrase string, exact boolean"
    )
    labels = {(r.doc_id, m.label, m.base) for r in L.scan(docs, table, keep=["doc_id"]).collect() for m in r.matches}
    assert (14, "m", False) in labels and (1, None, True) in labels and {x[1] for x in labels} == {"m", None}
    assert L.scan(docs, table.limit(0)).filter("size(matches) > 0").count() == 0
    monkeypatch.setattr(L, "MAX_WORDS", 3)
    with pytest.raises(ValueError):
        L.scan(docs, table)
