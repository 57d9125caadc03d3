"""Line dedup with a log-template tree.

Fixed-depth tree (He et al. 2017, Drain): a line descends by its number of tokens,
then by its first ``LEAD`` tokens; tokens with a digit are variable fields and read
``<*>`` from the start.  In a group of lines, at first the leaf, the template keeps, at
each position, the token that most of the lines have (``<*>`` where none reaches half),
and a line belongs to it when it agrees with at least ``SIMILARITY`` of the positions.
A line that recurs by itself, variable fields aside, is a template of its own.  Lines
whose template occurs in at least ``MIN_DOCS`` documents are dropped.

A leaf may hold several templates.  Its lines that belong to none yet are split once,
by their tokens at one position: the one with the fewest distinct tokens (the first of
equals) among those with at least two tokens of which one stands in enough documents.
Each line is in one group, and each group has a template of its own.

The parse is order-free, so it needs no running state: counts per distinct masked
line are combined before any shuffle, and a leaf's template comes from weighted counts
per position.  A line that a third of all documents share is one row from the first
aggregation on; joins back to the lines have staged right sides, so AQE can split it.
At first only leaves are counted, from a line's leading tokens and blanks; whole lines
are masked where a bitmap of the leaves with enough lines lets them pass, and documents
meet the lines they lose by a bitmap too, so texts that lose none are never shuffled.

Defined cases: blank lines stay; a line of one or two tokens is its own template, as
its leaf is the whole mask; a line of fields alone has the mask of all such lines of
its length; a null text stays null and has no lines, an empty text has one empty line; rows equal
in doc_id and text count as one document and are cleaned alike; an empty table gives
an empty result; other columns pass through ``drop_recurring`` (its own new columns
are n_lines, n_dropped and clean_text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import staged, table
from filingfold.operators.prefilter import bitmap_bits, flagged, id_bitmap, thinned

LEAD = 3
MIN_TOKENS = 1
MIN_DOCS = 5
SIMILARITY = 0.6
FIELD = "<*>"
KEY = ["k1", "k2"]


def keyed(docs: DataFrame) -> DataFrame:
    """(row, text, k1, k2): the row packed, so that none of its names can clash, and a
    128-bit key of (doc_id, text)."""
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), "text",
        F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("k2"),
    )


def plain(body: Column) -> Column:
    """The line's tokens, one blank between; most lines are so already."""
    odd = F.startswith(body, F.lit(" ")) | F.endswith(body, F.lit(" "))
    for blank in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains(body, F.lit(blank))
    return F.when(odd, F.trim(F.regexp_replace(body, r"[\x20\x09-\x0D]+", " "))).otherwise(body)


def masked(tokens: Column) -> Column:
    """Tokens with a digit as the field mark; each token is read once from its start."""
    return F.when(tokens.rlike("[0-9]"), F.regexp_replace(tokens, "(?<![^ ])[^ ]*?[0-9][^ ]*", FIELD)).otherwise(tokens)


def leaves(lines: DataFrame) -> DataFrame:
    """``lines`` with their leaf, from ``body``; blank lines are left out."""
    lines = lines.withColumn("body", plain(F.col("body"))).filter("body <> ''")
    count = F.octet_length("body") - F.octet_length(F.replace("body", F.lit(" "), F.lit(""))) + 1
    lines = lines.filter(count >= MIN_TOKENS)
    return lines.withColumn("leaf", F.xxhash64(count, masked(F.substring_index("body", " ", LEAD))))


def node_templates(lines: DataFrame) -> DataFrame:
    """(node, template) from the distinct masked lines (node, tokens, docs): the
    majority token of each position, or the field mark."""
    votes = (
        lines.select("node", "docs", F.posexplode("tokens").alias("place", "token"))
        .groupBy("node", "place", "token").agg(F.sum("docs").alias("votes"))
        .groupBy("node", "place").agg(F.max(F.struct("votes", "token")).alias("top"), F.sum("votes").alias("all"))
    )
    token = F.when(F.col("top.votes") * 2 >= F.col("all"), F.col("top.token")).otherwise(FIELD)
    # One entry per position of a line: the list is as long as the node's token count.
    return votes.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", token.alias("token")))).alias("t")).select(
        "node", F.transform("t", lambda x: x["token"]).alias("template")
    )


def _agreement() -> Column:
    return F.size(F.filter(F.zip_with("tokens", "template", lambda a, b: a == b), lambda same: same))


def _taken(lines: DataFrame, held: DataFrame, min_docs: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(taken, placed): the lines (node, leaf, mask, docs, tokens) that belong to their
    node's template where it stands in ``min_docs`` documents, and all lines with their
    node's template.  ``held`` has the documents (key, leaf, mask) of the masks."""
    templates = staged(node_templates(lines), "templates")
    placed = staged(lines.join(templates, "node").withColumn("fits", _agreement() >= F.lit(similarity) * F.size("tokens")), "placed")
    # A mask that recurs is enough; else the sum bounds the number of documents.
    fit = placed.filter("fits").groupBy("node").agg(F.max("docs").alias("most"), F.sum("docs").alias("sum"))
    fit = staged(fit.filter(F.col("sum") >= min_docs), "fit-nodes")
    sure = fit.filter(F.col("most") >= min_docs).select("node")
    unsure = placed.filter("fits").join(fit.filter(F.col("most") < min_docs), "node", "left_semi").select("leaf", "mask", "node")
    unsure = staged(unsure, "unsure")
    counted = held.join(unsure, ["leaf", "mask"]).select(*KEY, "node").distinct().groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    sure = staged(sure.unionByName(counted.filter(F.col("n") >= min_docs).select("node")), "recurrent")
    return placed.filter("fits").join(sure, "node", "left_semi").select("leaf", "mask", "template"), placed


def _split(rest: DataFrame, min_docs: int) -> DataFrame:
    """``rest`` (leaf, mask, docs, tokens) with nodes by the token at their leaf's
    splitting position; nodes of too few documents are left out."""
    total = rest.groupBy("leaf").agg(F.sum("docs").alias("total")).filter(F.col("total") >= min_docs).select("leaf")
    rest = rest.join(staged(total, "leaf-totals"), "leaf", "left_semi")
    votes = rest.select("leaf", "docs", F.posexplode("tokens").alias("place", "token")).groupBy("leaf", "place", "token").agg(F.sum("docs").alias("votes"))
    places = votes.groupBy("leaf", "place").agg(F.count(F.lit(1)).alias("kinds"), F.max("votes").alias("most"))
    by = places.filter((F.col("kinds") > 1) & (F.col("most") >= min_docs)).groupBy("leaf").agg(F.min(F.struct("kinds", "place")).alias("by"))
    by = staged(by.select("leaf", "by.place"), "places")
    nodes = rest.join(by, "leaf").withColumn("node", F.xxhash64("leaf", F.lit("split"), F.element_at("tokens", F.col("place") + 1))).drop("place")
    nodes = staged(nodes, "split")
    enough = nodes.groupBy("node").agg(F.sum("docs").alias("total")).filter(F.col("total") >= min_docs).select("node")
    return nodes.join(staged(enough, "node-totals"), "node", "left_semi")


def members(distinct: DataFrame, held: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """(leaf, mask, template) of the distinct masked lines (leaf, mask, docs, tokens) that
    belong to a template in ``min_docs`` documents: of their leaf, or of their part of
    what is left of it."""
    columns = ["leaf", "mask", "docs", "tokens"]
    first, placed = _taken(distinct.withColumn("node", F.col("leaf")), held, min_docs, similarity)
    first = staged(first, "members")
    rest = placed.select(columns).join(first.select("leaf", "mask"), ["leaf", "mask"], "left_anti")
    second, _ = _taken(_split(staged(rest, "rest"), min_docs), held, min_docs, similarity)
    return first.unionByName(second)


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(lines, recurrent): the lines (key, line, leaf, mask) of leaves with enough
    documents, and the (leaf, mask, template) of those to be dropped."""
    bodies = leaves(docs.select(*KEY, F.posexplode(F.split("text", "\n")).alias("line", "body")))
    common = staged(bodies.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("leaf"), "leaves")
    bits = bitmap_bits(common.count())
    bodies = bodies.join(common, "leaf", "left_semi") if bits is None else thinned(bodies, "leaf", id_bitmap(common, "leaf", bits), bits)
    lines = bodies.withColumn("masked", masked(F.col("body"))).select(*KEY, "line", "leaf", F.xxhash64("masked").alias("mask"), "masked")
    lines = staged(lines, "lines")
    # A document may hold several lines of a leaf or mask; it counts once.
    seen = staged(lines.select(*KEY, "leaf", "mask").distinct(), "seen")
    busy = seen.select(*KEY, "leaf").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)
    busy = staged(busy.select("leaf"), "busy")
    marks = staged(seen.groupBy("leaf", "mask").agg(F.count(F.lit(1)).alias("docs")).join(busy, "leaf", "left_semi"), "marks")
    texts = lines.groupBy("leaf", "mask").agg(F.min("masked").alias("masked"))
    distinct = staged(marks.join(texts, ["leaf", "mask"]).select("leaf", "mask", "docs", F.split("masked", " ").alias("tokens")), "distinct-lines")
    held = staged(seen.join(marks.filter(F.col("docs") < min_docs).select("leaf", "mask"), ["leaf", "mask"]), "rare")
    member = staged(members(distinct, held, min_docs, similarity), "members")
    decided = distinct.join(member, ["leaf", "mask"], "left").filter((F.col("docs") >= min_docs) | F.col("template").isNotNull())
    return lines.drop("masked"), decided.select("leaf", "mask", F.coalesce("template", "tokens").alias("template"))


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with n_lines, n_dropped and clean_text, the text without the lines of
    recurring templates."""
    rows = keyed(docs)  # n_lines, n_dropped, clean_text must not be in the input
    lines, drop = recurring(rows, min_docs, similarity)
    drop = staged(drop.select("leaf", "mask"), "dropped")
    # Line numbers of one text: as many as the text has lines.
    gone = staged(lines.join(drop, ["leaf", "mask"]).groupBy(*KEY).agg(F.collect_set("line").alias("gone")), "gone")
    every = F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    rows = rows.withColumn("n_lines", every)
    bits = bitmap_bits(gone.count())
    if bits is None:
        marked = rows.select(F.struct(*rows.columns).alias("row"), F.lit(True).alias("hit"))
    else:
        ids = staged(gone.select("k1").distinct(), "gone-ids")
        marked = flagged(rows, "k1", id_bitmap(ids, "k1", bits), bits)
    whole = marked.filter("NOT hit").select("row.*").select("row", "n_lines", F.lit(0).cast("long").alias("n_dropped"), F.col("text").alias("clean_text"))
    # Split below the join, so that each line is found in the list in one step.
    hit = marked.filter("hit").select("row.*").withColumn("parts", F.split("text", "\n")).drop("text")
    met = hit.join(gone, KEY, "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone")
    kept = F.when(F.col("parts").isNotNull(), F.array_join(F.transform(stay, lambda i: F.element_at("parts", i + 1)), "\n"))
    cut = met.select("row", "n_lines", F.size("gone").cast("long").alias("n_dropped"), kept.alias("clean_text"))
    return whole.unionByName(cut).select("row.*", "n_lines", "n_dropped", "clean_text")


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring(docs).select("doc_id", "n_lines", "n_dropped", "clean_text")
