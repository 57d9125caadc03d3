from __future__ import annotations

import re

import pytest

from filingfold.llm import decontaminate as D
from tests.llm.helpers import DOCS, SF, benchmark, empty_docs, odd_docs, odd_rows


def brute_canonical(text):
    """(canonical word, original lower-cased word) in order."""
    out, previous_end, previous_num = [], None, False
    for m in re.finditer(r"[A-Za-z0-9\u0080-\U0010ffff]+", text or ""):
        w = m.group()
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
        opened = previous_end is None or re.search(r"[.!?:\n\r]", text[previous_end : m.start()]) is not None
        if re.search("[0-9]", w):
            shape = "<num>"
        elif previous_num and low in D.UNITS:
            shape = "<unit>"
        elif not opened and len(w.encode()) > 1 and "A" <= w[0] <= "Z" and sum("A" <= c <= "Z" for c in w) == 1:
            shape = "<name>"
        else:
            shape = low
        out.append((shape, low))
        previous_end, previous_num = m.end(), shape == "<num>"
    return out


def windows(text, item):
    c = brute_canonical(text)
    k = min(D.WINDOW, len(c))
    all_ = [(tuple(s for s, _ in c[i : i + k]), i) for i in range(len(c) - k + 1)] if c else []
    if item:
        good = [w for w in all_ if sum(not s.startswith("<") for s in w[0]) >= min(D.LITERALS, k)]
        return c, good or all_
    return c, all_


def brute(docs, items):
    out = {}
    for doc_id, text in docs:
        c, own = windows(text, False)
        for item_id, question in items:
            q, wanted = windows(question, True)
            if not wanted:
                continue
            names = {w for w, _ in wanted}
            if len(names & {w for w, _ in own}) < D.SHARE * len(names):
                continue
            votes: dict = {}
            for w, p in own:
                for v, at in wanted:
                    if v == w:
                        for j, s in enumerate(w):
                            if s.startswith("<"):
                                group = votes.setdefault((p - at, q[at + j][1]), {})
                                group[c[p + j][1]] = group.get(c[p + j][1], 0) + 1
            total = sum(sum(g.values()) for g in votes.values())
            if not total or sum(max(g.values()) for g in votes.values()) >= D.SHARE * total:
                out.setdefault(doc_id, []).append(item_id)
    return out


QUESTION = "A train leaves Paris with 120 people at noon and reaches Lyon after 3 hours of travel. How many people were in Lyon when the train from Paris got there?"


def test_op2_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute(docs, items)
    rows = D.op2_template_decontamination(spark, SF).collect()
    assert len(rows) == len(docs) and want
    assert {r.doc_id: r.item_ids for r in rows if r.contaminated} == {d: sorted(i) for d, i in want.items()}


@pytest.mark.parametrize("limit", [D.FILTER_WINDOWS, 0])
def test_reparameterised_and_inconsistent(spark, limit, monkeypatch):
    monkeypatch.setattr(D, "FILTER_WINDOWS", limit)
    changed = QUESTION.replace("Paris", "Milan").replace("Lyon", "Turin").replace("120", "75").replace("3 hours", "40 minutes")
    mixed = changed.replace("from Milan", "from Oslo").replace("in Turin", "in Bergen")
    texts = [(1, "Intro words here.\n" + QUESTION), (2, "Some words first. " + changed + " And more."), (3, mixed), (4, "Nothing alike at all in this text, not one bit."), (5, QUESTION[:60])]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], DOCS)
    found = {r.doc_id: r for r in D.keyed(docs).join(D.contaminations(D.keyed(docs).select("k1", "k2", "text"), benchmark(spark, [(7, QUESTION), (8, None)])), D.KEY).collect()}
    assert set(found) == set(brute(texts, [(7, QUESTION)])) == {1, 2}
    assert not found[1].reparameterised and found[2].reparameterised
    assert sorted(r.doc_id for r in D.decontaminate(docs, benchmark(spark, [(7, QUESTION)])).collect()) == [3, 4, 5]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    items = benchmark(spark, [(1, odd_rows()[0][1]), (2, "word"), (3, None), (4, ""), (None, "negative id text"), (2, "word")])
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {1, 2, 3, 7, 8} & set(ids) and {4, 5, 6, 9, 10, 11, 12, 13, 14} <= set(ids)
    assert sorted(set(brute([(r[0], r[1]) for r in odd_rows()], [(1, odd_rows()[0][1]), (2, "word")])) - {None}) == [1, 2, 3, 7, 8]
    assert D.decontaminate(docs, benchmark(spark)).count() == len(odd_rows())
    assert D.decontaminate(empty_docs(spark), items).count() == 0


def hits(spark, texts, items):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], DOCS)
    rows = D.keyed(docs).join(D.contaminations(D.keyed(docs).select("k1", "k2", "text"), benchmark(spark, items)), D.KEY).collect()
    return {(r.doc_id, r.item_id) for r in rows}


@pytest.mark.parametrize("limit", [D.FILTER_WINDOWS, 0])
def test_short_items_inside_longer_documents(spark, limit, monkeypatch):
    """Items of 1, 3, 4 and 6 words in the middle of a sentence, after a name-like place or a number."""
    monkeypatch.setattr(D, "FILTER_WINDOWS", limit)
    items = [(1, "Xylophone"), (2, "Name three rivers"), (3, "Days without any rain"), (4, "Which planet has the most moons")]
    texts = [(i, f"They were asked once more {text} and nobody in the room knew") for i, text in items]
    texts += [(5, "after 12 Days without any rain we left"), (6, "They name three other rivers and days without rain and which planet has moons")]
    assert hits(spark, texts, items) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 3)}


def test_items_without_telling_windows_need_their_own_words(spark):
    items = [(1, "2 4 6 8 10"), (2, "42"), (3, "2 4 6 8 10 12 14")]
    texts = [(1, "a row 1 3 5 7 9 11 13 15 of a table"), (2, "count on: 2 4 6 8 10 and stop"), (3, "it was 42 then"), (4, "on 2 4 6 8 10 12 14 go")]
    assert hits(spark, texts, items) == {(2, 1), (3, 2), (4, 1), (4, 3)}


def test_a_phrase_of_many_items_and_documents_makes_no_pairs(spark, monkeypatch):
    """60 items and 200 documents share one phrase: pairs stay with the documents that hold an item."""
    phrase = "in the year of the great comet over the river"
    items = [(i, f"{phrase} how far did walker w{chr(97 + i % 26)}{chr(97 + i // 26)} go beyond the old stone bridge at dawn alone") for i in range(60)]
    texts = [(i, f"page {chr(97 + i % 26)} tells that {phrase} nothing else was seen at all") for i in range(200)]
    texts += [(1000 + i, f"And so: {items[i][1]} today") for i in range(5)]
    sizes = {}
    staged = D.staged

    def counting(df, label):
        out = staged(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(D, "staged", counting)
    got = hits(spark, texts, items)
    assert got == {(d, i) for d, found in brute(texts, items).items() for i in found}
    assert {(1000 + i, i) for i in range(5)} <= got
    assert sizes["hits"] > 200 * 5 and sizes["candidates"] <= 5 * 60 and sizes["met"] < 200 * 60
