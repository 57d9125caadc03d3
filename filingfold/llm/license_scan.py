"""License scan: exact set-similarity join of text blocks with a table of templates.

A block is a run of as many consecutive words as the template has (fewer only at the
end of a text).  It matches when it holds at least ``threshold`` of the template's
distinct words (``need`` of them).  Template words are ranked by their frequency over all
documents, rarest first, and blocks are seen as sets of ranked words; words of no template
fall away.  Four conditions find every matching block, each of them once:

* prefix: a matching block's rarest common word is one of the template's rarest
  ``|T| - need + 1``.  Places of such words are taken inside the scan and join the
  template table by word; a block belongs to the first place of its rarest common word.
* length: a block, and before it the words around a place, has at least ``need`` words of
  the template table; the words around a place, at least ``need`` of its own template.
* position: that common word, and the block's words ranked behind it, are at least ``need``.
* verification: the common words are at least ``need``; a phrase that must stand word for
  word is compared word for word.

Templates are a table (label, phrase, exact) of at most ``MAX_WORDS`` words, more are an
error; so the index that is broadcast is bounded, and plans don't grow with it.
Words are runs of ASCII letters and digits (A-Z lower-cased) and of anything outside ASCII.

Defined cases: a null or empty text has no words and no match; a template without words,
or null, matches nothing; repeated rows match each by itself; an empty table gives an empty
result; existing columns ``n_words`` and ``matches`` are replaced, other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import ascii_lower, staged, table, text_or_empty

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
MAX_WORDS = 1_000_000

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Templates that match by containment.
TEMPLATES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-text",
    "licensed under the creative commons attribution share alike license": "cc-by-sa",
    "unless required by applicable law or agreed to in writing software is distributed on an as is basis": "apache-text",
    "all rights reserved": "all-rights-reserved",
}

PROBE_SCHEMA = "w string, rank int, template int"
TEMPLATE_SCHEMA = "template int, label string, exact boolean, tokens array<int>, own array<int>, names array<string>, need int"


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), NOT_WORD), lambda w: w != "")


def template_table(spark: SparkSession, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """The given phrases as a table (label, phrase, exact)."""
    rows = [(label, p, True) for p, label in base.items()] + [(label, p, False) for p, label in templates.items()]
    return spark.createDataFrame(rows, "label string, phrase string, exact boolean")


def _listed(templates: DataFrame) -> list[tuple[str, list[str], bool]]:
    """(label, words, exact) of each template that has words."""
    worded = templates.select("label", words_of(F.col("phrase")).alias("words"), F.coalesce("exact", F.lit(False)).alias("exact"))
    worded = worded.filter(F.size("words") > 0)
    if (worded.agg(F.sum(F.size("words"))).first()[0] or 0) > MAX_WORDS:
        raise ValueError(f"templates of more than {MAX_WORDS} words")
    return [(r["label"], r["words"], r["exact"]) for r in worded.collect()]


def token_counts(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each template token occurs in all documents (``words.words``); one
    row per token of the templates reaches the driver."""
    known = words.select(F.explode(F.filter("words", lambda w: w.isin(vocabulary))).alias("w"))
    return {r["w"]: r["n"] for r in known.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def index(listed: list[tuple[str, list[str], bool]], ranks: dict[str, int], threshold: float) -> tuple[list[tuple], list[tuple]]:
    """Rows of ``PROBE_SCHEMA``, one for each prefix word of a template, and of ``TEMPLATE_SCHEMA``."""
    probes, rows = [], []
    for t, (label, words, exact) in enumerate(listed):
        names = sorted(set(words), key=ranks.__getitem__)
        need = len(names) if exact else max(1, math.ceil(threshold * len(names) - 1e-9))
        probes += [(w, ranks[w], t) for w in names[: len(names) - need + 1]]
        rows.append((t, label, exact, [ranks[w] for w in words], [ranks[w] for w in names], names, need))
    return probes, rows


def hits(probes: list[str], vocabulary: list[str], longest: int, need: int) -> Column:
    """Places ``i`` of prefix words ``w`` in ``words``, each with the words around it from
    ``start`` on; places with fewer than ``need`` template words around them are left out."""
    n = F.size("words")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    start = lambda i: F.greatest(i - (longest - 1), F.lit(0))
    around = F.transform(
        F.filter(places, lambda i: F.get("words", i).isin(probes)),
        lambda i: F.struct(
            i.alias("i"), F.get("words", i).alias("w"), start(i).alias("start"),
            F.slice("words", start(i) + 1, i - start(i) + longest).alias("around"),
        ),
    )
    return F.filter(around, lambda h: F.size(F.array_distinct(F.filter(h["around"], lambda w: w.isin(vocabulary)))) >= need)


def candidates(places: DataFrame, probes: DataFrame, templates: DataFrame) -> DataFrame:
    """Prefix filter: places (id, i, w, start, around) joined with the templates that have
    ``w`` in their prefix and ``need`` words around it.  Both tables are bounded by ``MAX_WORDS``."""
    met = places.join(F.broadcast(probes), "w").join(F.broadcast(templates), "template")
    return met.filter(F.size(F.array_intersect("around", "names")) >= F.col("need"))


def blocks_at(met: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The blocks around each place: ``block`` in ranks (0: in no template) from word ``s`` on,
    ``seen`` its set in order of rank, ``common`` the template's part of it."""
    order = F.lit(vocabulary) if vocabulary else F.array().cast("array<string>")
    ranked = met.withColumn("around", F.transform("around", lambda w: F.array_position(order, w).cast("int")))
    first = F.greatest(F.col("i") - F.size("tokens") + 1, F.lit(0))
    at = ranked.withColumn("s", F.explode(F.sequence(first, F.col("i"))))
    at = at.withColumn("block", F.slice("around", F.col("s") - F.col("start") + 1, F.size("tokens"))).drop("around")
    at = at.withColumn("seen", F.array_sort(F.array_distinct(F.filter("block", lambda r: r > 0))))
    return at.withColumn("common", F.array_intersect("seen", "own"))


def by_length(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.size("seen") >= F.col("need"))


def by_first_word(blocks: DataFrame) -> DataFrame:
    """Blocks whose rarest common word is the one they were found by, at its first place."""
    here = F.array_position("block", F.col("rank")) == F.col("i") - F.col("s") + 1
    return blocks.filter((F.get("common", F.lit(0)) == F.col("rank")) & here)


def by_position(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.size(F.filter("seen", lambda r: r >= F.col("rank"))) >= F.col("need"))


def verified(blocks: DataFrame) -> DataFrame:
    same = F.when(F.col("exact"), F.col("block") == F.col("tokens")).otherwise(F.lit(True))
    return blocks.filter((F.size("common") >= F.col("need")) & same)


def scan(docs: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with ``n_words`` and ``matches``: array of (label,
    first_word, end_word, containment, base), sorted; word positions from 0, end exclusive."""
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "matches")]
    row = F.struct(*[docs[c] for c in kept]).alias("row")  # packed: no name can clash
    worded = docs.select(row, words_of(text_or_empty()).alias("words"))
    listed = _listed(template_table(spark) if templates is None else templates)
    counts = token_counts(worded, sorted({w for _, words, _ in listed for w in words}))
    vocabulary = sorted({w for _, words, _ in listed for w in words}, key=lambda w: (counts.get(w, 0), w))
    probes, rows = index(listed, {w: i + 1 for i, w in enumerate(vocabulary)}, threshold)
    found = hits(sorted({p[0] for p in probes}), vocabulary, max((len(r[3]) for r in rows), default=1), min((r[6] for r in rows), default=1))
    # Ids are fixed by writing them; each row is a key of its own, so copies make none hot.
    numbered = staged(
        worded.select("row", F.size("words").cast("long").alias("n_words"), found.alias("hits"), F.monotonically_increasing_id().alias("id")),
        "license-hits",
    )
    places = numbered.filter(F.size("hits") > 0).select("id", F.explode("hits").alias("hit")).select("id", "hit.*")
    met = candidates(places, spark.createDataFrame(probes, PROBE_SCHEMA), spark.createDataFrame(rows, TEMPLATE_SCHEMA))
    matching = verified(by_position(by_first_word(by_length(blocks_at(met, vocabulary)))))
    match = F.struct(
        "label", F.col("s").cast("long").alias("first_word"), (F.col("s") + F.size("block")).cast("long").alias("end_word"),
        (F.size("common") / F.size("own")).alias("containment"), F.col("exact").alias("base"),
    )
    matches = matching.groupBy("id").agg(F.sort_array(F.collect_list(match)).alias("matches"))  # of one text
    none = F.array().cast(matches.schema["matches"].dataType)
    return (
        numbered.select("row", "n_words", "id").join(matches, "id", "left")
        .select("row.*", "n_words", F.coalesce("matches", none).alias("matches"))
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("matches", lambda m: m["base"])
    firsts = F.transform("base", lambda m: m["first_word"])
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda m: m["label"]))), ",")
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        labels("base").alias("base_labels"), labels("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"),
    )


# Every window by its words: an occurrence of a template's word counts for each block that covers it.
_ROWS = ", ".join(
    [f"('{label}', '{p}', true)" for p, label in BASE.items()] + [f"('{label}', '{p}', false)" for p, label in TEMPLATES.items()]
)
OP9_SQL = rf"""
WITH given(label, phrase, exact) AS (VALUES {_ROWS}),
templates AS (
  SELECT label, exact, string_split(phrase, ' ') AS tokens, len(string_split(phrase, ' ')) AS n,
    len(list_distinct(string_split(phrase, ' '))) AS own FROM given
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), places AS (
  SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i FROM docs
), tokens AS (
  SELECT label, exact, n, own, unnest(tokens) AS w, generate_subscripts(tokens, 1) - 1 AS j FROM templates
), covered AS (
  SELECT p.r, t.label, t.exact, t.n, t.own, p.w, p.i, unnest(range(greatest(p.i - t.n + 1, 0), p.i + 1)) AS s
  FROM places p JOIN (SELECT DISTINCT label, exact, n, own, w FROM tokens) t ON p.w = t.w
), blocks AS (
  SELECT c.r, c.label, c.exact, c.n, c.own, c.s, count(DISTINCT c.w) AS k, count(t.j) AS in_place
  FROM covered c LEFT JOIN tokens t ON c.label = t.label AND c.exact = t.exact AND c.w = t.w AND c.i - c.s = t.j
  GROUP BY ALL
), matches AS (
  SELECT * FROM blocks
  WHERE CASE WHEN exact THEN in_place = n ELSE k >= ceil({THRESHOLD} * own - 1e-9) END
), found AS (
  SELECT r, count(*) FILTER (WHERE exact) AS n_base, min(s) FILTER (WHERE exact) AS first_word,
    max(s) FILTER (WHERE exact) AS last_word, max(k / own) AS score,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM matches GROUP BY r
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(f.n_base, 0) AS n_base, f.first_word, f.last_word,
  coalesce(f.base_labels, '') AS base_labels, coalesce(f.labels, '') AS labels, coalesce(f.score, 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN found f ON d.r = f.r
"""
