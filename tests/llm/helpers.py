from __future__ import annotations

import itertools

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside, as columns of the input.
CLASHES = ["row", "id", "n", "size", "key", "keys", "k1", "k2", "_k1", "words", "hits", "block", "_block", "component", "bucket", "label", "turn", "place"]


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    prose = "The old mill by the river was sold to a man from the north, and nobody asked why."
    rows = [
        (1, prose, "en", "a", 10), (2, prose, "en", "a", 10), (2, prose, "en", "a", 10), (3, prose.upper(), "en", "a", None),
        (4, None, "en", "a", None), (5, "", "en", None, 0), (6, " \n\t ", None, None, 1), (None, prose, "en", "b", 3),
        (None, None, None, None, None), (7, "word", "de", "b", 4), (8, "word", "de", "b", 4), (9, "123 456", "fr", "b", 7),
        (10, " ".join(f"w{i % 977}x" for i in range(60_000)), "en", "c", None), (11, "x" * 200_000, "en", "c", None),
        (12, "Ünïcödé 東京 😀 ſtraße", "de", "c", 5), (13, "line one is here\n" * 40, "en", "c", 5),
        (14, "Released under the MIT License.\nmail a.b@example.com or +1 (212) 555-0199", "en", "c", 5), (-5, "negative id text", "en", "d", 1),
    ]
    return rows


def odd_docs(spark, extra: bool = True):
    rows = odd_rows()
    if not extra:
        return spark.createDataFrame(rows, DOCS)
    schema = DOCS + "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *("x" if i % 2 else None for i, _ in enumerate(CLASHES))) for r in rows], schema)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def components(nodes, links) -> dict:
    """Least node reachable, by plain union-find."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shingle_set(text: str | None, k: int) -> frozenset:
    import re

    low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def pairs_at_least(sets: dict, percent: int):
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
            if 100 * len(x & y) >= percent * len(x | y):
                yield a, b
